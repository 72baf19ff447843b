import random

import corpus_pipeline
from tests.llm.test_bpe import library
from tests.llm.test_decontaminate import brute as similarity
from tests.llm.test_near_dedup import brute as near


def test_every_stage_takes_effect(spark, words, tmp_path):
    rng = random.Random(12)
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, say(30)) for k in range(5)]
    docs = [(i, say(rng.choice([30, 80]))) for i in range(150)]
    bad = [(i, " ".join(w.upper() + "!!" for w in say(40).split())) for i in range(200, 260)]
    copies = [(300 + k, docs[k][1].upper() if k % 2 else docs[k][1]) for k in range(10)]
    near_copies = [(320 + k, docs[k + 20][1] + " " + say(1)) for k in range(10)]
    leaks = [(340 + k, say(20) + "\n" + items[k][1] + ". " + say(20)) for k in range(5)]
    rows = [(i, t, "en", "s", len(t)) for i, t in docs + bad + copies + near_copies + leaks]
    rng.shuffle(rows)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(not 200 <= i < 260), 0) for i, *_ in rows], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    left = {}
    for i, t in sorted(r[:2] for r in rows if not 200 <= r[0] < 260):
        left[t.lower()] = (i, t)  # the largest id of each text
    left = sorted(left.values())
    kept = {i for i, _, _, k in near(left) if k}
    want = {i: len(library().encode_ordinary(t)) for i, t in left if i in kept and all(similarity(t, x) < 0.8 for _, x in items)}
    assert got == want and not any(340 <= i < 345 for i in got)


def test_near_copies_count_from_four_fifths(spark, words):
    rng = random.Random(4)
    base = [rng.choice(words) for _ in range(104)]  # 100 shingles
    rows = [(1, " ".join(base)), (2, " ".join([*base[:-18]])), (3, " ".join(base[:-26]))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r.doc_id for r in corpus_pipeline.unlike(spark, docs, "").collect()) == [1]
    assert sorted(r.doc_id for r in corpus_pipeline.unlike(spark, docs.where("doc_id <> 2"), "").collect()) == [1, 3]
