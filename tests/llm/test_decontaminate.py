import random

import numpy as np

from tidemark.llm import decontaminate as d

ITEM = "item_id bigint, text string, similarity int"
DOC = "doc_id bigint, text string, item_id string, tid int"


def brute(text, item):
    """Best similarity of any window of the item's size."""
    t, i = d.words(text), d.words(item)
    if not i or not t:
        return 0.0
    if len(i) < d.WORDS:
        return float(t == i)
    from collections import Counter

    def runs(w):
        return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))

    return max((d.similarity(runs(t[k : k + len(i)]), runs(i)) for k in range(len(t) - len(i) + 1)), default=0.0)


def corpus(words):
    rng = random.Random(8)
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, say(rng.choice([3, 5, 6, 12, 30, 60]))) for k in range(40)] + [(40, None), (41, ""), (42, "go go go go go go go go"), (None, say(20))]
    docs = []
    for k in range(120):
        text = say(rng.choice([0, 2, 40, 300]))
        if k % 2:
            w = (items[rng.randrange(43)][1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(words)
            text = f"{text}\n{' '.join(w).upper() if k % 3 else ', '.join(w)}. {say(rng.choice([0, 30]))}"
        docs.append((k, text))
    docs += [(None, items[3][1]), (7, None), (8, ""), (8, items[0][1]), (8, items[0][1]), (900, say(60000) + " " + items[5][1])]
    return docs, items


def test_find_equals_brute_force(spark, words):
    docs, items = corpus(words)
    frame = spark.createDataFrame([(*r, "x", 1) for r in docs], DOC)
    bench = spark.createDataFrame([(*r, 1) for r in items], ITEM)
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in d.find(frame, bench).collect()}
    want = {}
    for i, t in docs:
        for k, item in items:
            if (s := round(brute(t, item), 9)) >= 0.8:
                want[i, k] = max(s, want.get((i, k), 0))
    assert got == want and len(want) > 30
    kept = d.clean(frame, bench)
    assert kept.columns == ["doc_id", "text", "item_id", "tid"]
    bad = [any(brute(t, item) >= 0.8 for _, item in items) for _, t in docs]
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text is not None) == sorted(r for r, b in zip(docs, bad) if not b and r[1] is not None)


def test_items_in_several_blocks(spark, words, monkeypatch):
    docs, items = corpus(words)
    frame = spark.createDataFrame([(*r, "x", 1) for r in docs], DOC)
    bench = spark.createDataFrame([(*r, 1) for r in items], ITEM)
    one = sorted(map(str, d.find(frame, bench).collect()))
    monkeypatch.setattr(d, "ITEMS_BYTES", 2000)
    assert sorted(map(str, d.find(frame, bench).collect())) == one


def test_index_finds_every_fingerprint_within_the_radius(words):
    rng = random.Random(5)
    items = [(k, " ".join(rng.choice(words) for _ in range(20))) for k in range(50)]
    index = d.Index(items)
    prints = index.prints[20]
    for _ in range(400):
        near = int(prints[rng.randrange(50)])
        for b in rng.sample(range(64), rng.randint(0, 22)):
            near ^= 1 << b
        near = np.array([near], np.uint64)
        assert index.within(20, near)[1].tolist() == np.flatnonzero(np.bitwise_count(prints ^ near) <= d.RADIUS).tolist()


def test_empty_tables(spark):
    none, bench = spark.createDataFrame([], DOC), spark.createDataFrame([(1, "a b c d e f", 1)], ITEM)
    some = spark.createDataFrame([(1, "a b c d e f", "x", 1)], DOC)
    assert d.find(none, bench).collect() == [] == d.find(some, bench.limit(0)).collect()
    assert d.clean(some, bench).collect() == []


def test_documents_shorter_than_the_item(spark, words):
    from collections import Counter

    rng = random.Random(9)
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([8, 20, 59])))) for k in range(30)]
    docs = []
    for k, text in items:
        w = text.split()
        docs += [(10 * k + cut, " ".join(w[:-cut] if k % 2 else w[cut:])) for cut in (1, 2, 4, 6) if len(w) - cut >= d.WORDS]

    def runs(text):
        w = d.words(text)
        return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))

    want = {}
    for i, t in docs:
        for k, item in items:
            short = len(d.words(t)) < len(d.words(item))
            if (s := round(d.similarity(runs(t), runs(item)) if short else brute(t, item), 9)) >= 0.8:
                want[i, k] = s
    frame = spark.createDataFrame([(*r, "x", 1) for r in docs], DOC)
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in d.find(frame, spark.createDataFrame([(*r, 1) for r in items], ITEM)).collect()}
    assert got == want and len(want) > 40
