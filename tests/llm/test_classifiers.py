import random
import zlib

import pytest

from tidemark.llm import rules, toxicity

DOC = "doc_id bigint, text string, score string, _label int, words int"
LABEL = "doc_id bigint, quality int, toxic int"


def corpus(words, n=500):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.choice([20, 60, 200]))]
        bad, toxic = i % 4 == 0, i % 5 == 1
        if toxic:
            for k in rng.sample(range(len(w)), 5):
                w[k] = rng.choice(["idiot", "scum", "moron"])
        if bad:
            w = [x.upper() + "!!" for x in w] if i % 8 else [x + rng.choice(["###", "$$$"]) for x in w]
        docs.append((i, " ".join(w) + ".", "s", 7, 1))
        labels.append((i, int(not bad), int(toxic)))
    docs += [(n, None, None, 1, 1), (n + 1, "", None, 1, 1), (None, "text", None, 1, 1), (3, docs[3][1], "s", 7, 1), (n + 2, "word " * 40000, "s", 7, 1)]
    return docs, labels + [(None, 1, 0), (3, 1, 0), (n + 5, 1, 1), (2, None, None)]


@pytest.mark.parametrize("judge, column, modulus, remainder", [(rules.judge, 1, 3, 1), (toxicity.judge, 2, 5, 0)])
def test_held_out_rows_are_told_apart(spark, words, judge, column, modulus, remainder):
    docs, labels = corpus(words)
    out = judge(spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, LABEL)).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % modulus == remainder)
    known = {r[0]: r[column] for r in labels if r[0] is not None and r[0] < 500 and r[column] is not None}
    held = [(r.predicted, known[r.doc_id]) for r in out if r.held_out and r.doc_id in known]
    assert sum(p == t for p, t in held) / len(held) > 0.97


@pytest.mark.parametrize("judge", [rules.judge, toxicity.judge])
def test_without_two_labels_every_text_gets_the_share(spark, judge):
    docs = spark.createDataFrame([(i, "t", "s", 1, 1) for i in range(6)], DOC)
    assert {r.score for r in judge(docs, spark.createDataFrame([], LABEL)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 1) for i in range(6)], LABEL)
    got = {r.score for r in judge(docs, ones).collect()}
    assert len(got) == 1 and 0.5 < got.pop() < 1
    assert judge(docs.limit(0), ones).collect() == []


def test_rejected_rows_go_and_columns_stay(spark):
    docs = spark.createDataFrame([(1, "fine words", "s", 1, 1), (2, None, "s", 1, 1)], DOC)
    model = rules.Ensemble(-1.0, (rules.Rule((("chars", ">", 1.0),), 3.0),))
    kept = rules.keep_good(docs, model)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
