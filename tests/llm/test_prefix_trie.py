import hashlib
import os
import random
import zlib

import pytest

from tidemark.llm import prefix_trie

SCHEMA = "conv_id bigint, turn int, role string, text string, depth int, id string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    def name(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]

    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, name(role or "", text or ""), role or "", text or ""))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}


def brute(convs):
    nodes = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    kids, below = {p: [] for p in nodes}, {p: [] for p in nodes}
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
        for d in range(len(p) + 1):
            below[p[:d]].append(p)
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(convs[c]) == len(p)))
        out.append((
            min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids[p]),
            sum(not kids[q] for q in below[p]), sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below[p] if q),
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)


def talk(seed, n, texts):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(n * 2), n):
        if c % 100 == 0 and rng.random() < 0.5:
            continue  # base conversations may be absent
        for t in range(rng.choice([1, 1, 2, 3, 6, 9])):
            role = rng.choice(["user", "assistant", None])
            rows.append((c, rng.choice([t, t, t, None, 3]), role, rng.choice(texts)))
    return rows


SMALL = prefix_trie.Sizes(section=3, tree=4000, piece=20)


@pytest.mark.parametrize("seed,n,texts", [(1, 300, ["a", "bé", "", None]), (2, 400, [f"t{k}" for k in range(300)]), (3, 150, ["x"])])
def test_equals_brute_force(spark, seed, n, texts):
    rows = talk(seed, n, texts)
    convs = ordered(rows)
    df = frame(spark, rows)
    turned = prefix_trie.turns(df)
    assert found(prefix_trie.trie(prefix_trie.plain(turned), SMALL)) == brute(convs)
    assert found(prefix_trie.judge(df)) == found(prefix_trie.trie(prefix_trie.rebuilt(turned), SMALL)) == brute(rebuilt(convs))


def test_nulls_repeats_and_an_empty_table(spark):
    rows = [(None, 0, "user", "lost"), (5, None, None, None), (5, 1, "user", "x" * 300_000), (5, 1, "user", "x" * 300_000), (7, 2, "user", "y")]
    assert found(prefix_trie.judge(frame(spark, rows))) == brute(rebuilt(ordered(rows)))
    assert found(prefix_trie.judge(frame(spark, rows).limit(0))) == []


def test_one_very_long_and_many_equal_conversations(spark):
    rows = [(1, t, "user", str(t % 3)) for t in range(400)] + [(c, t, "user", "same") for c in range(2, 300) for t in (0, 1)]
    keys = prefix_trie.plain(prefix_trie.turns(frame(spark, rows)))
    assert found(prefix_trie.trie(keys, SMALL)) == brute(ordered(rows))
    assert max(len(r.ids) for r in prefix_trie.sections(keys, SMALL).collect()) == 3 * prefix_trie.WIDTH


def test_node_layouts_grow_and_paths_split():
    rng = random.Random(3)
    keys = {}
    for n in (3, 16, 48, 200, 256):
        for b in rng.sample(range(256), n):
            keys[prefix_trie.ROOT + bytes([n] * 8) + bytes([b]) + os.urandom(7)] = 1
    tree = prefix_trie.Tree()
    for k in keys:
        tree.insert(k, (0, [0, 1]), (1, 0), 1, 2)
    kinds = {type(node.kids).__name__ for _, node, _ in tree.gather() if node.kids}
    assert kinds == {"Few", "Indexed", "Whole"}
    tree = prefix_trie.Tree()
    for k in keys:
        for _ in range(2):
            tree.insert(k, (0, [0, 1]), (1, 0), 1, 2)
    rows = list(tree.emit())
    assert [r for r in rows if r[1] is None] == [(prefix_trie.ROOT, None, 0, 0, 0, 1, 0, 2 * len(keys), 4 * len(keys))]
    assert sorted(r[0] for r in rows if r[1] is not None) == sorted(prefix_trie.chained(k[:16], k[16:]) for k in keys)
    assert all(r[7:] == (2, 4) for r in rows if r[1] is not None)
