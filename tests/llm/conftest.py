import random

import pytest


@pytest.fixture(scope="session")
def words():
    """Invented words, for texts whose shingles do not meet by chance."""
    rng = random.Random(1)
    return ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(3000)]


def union_find(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}
