import random
import re
import zlib
from collections import Counter

from tidemark.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n int"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k:] == b[k + 1:] or (len(a) == len(b) and a[k + 1:] == b[k + 1:])


def brute(docs):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    forms, out = {}, {}
    for w, c in n.items():
        near = sorted((-n[x], x) for x in n if one_edit(w, x))
        best = near[0] if near and -near[0][0] >= 2 * c else None
        forms[w] = best and best[1]
        out[w] = [c, len(near), best and -best[0], best and best[1]]
    for w in n:
        root = w
        while forms[root]:
            root = forms[root]
        out[w].append(root)
    return out


def got(df):
    return {r.word: [r.n, r.n_near, r.form_n, r.form, r.root] for r in spelling.judge(df.select("*")).collect()}


def corpus(seed, letters, length):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(*length))) for _ in range(60)]
    words = list(stems)
    for _ in range(500):
        w = list(rng.choice(words))
        k = rng.randrange(len(w))
        kind = rng.randrange(3)
        w[k:k + (kind > 0)] = rng.choice(letters) if kind < 2 else ""
        words.append("".join(w))
    docs = []
    for i in range(80):
        pick = [rng.choice(words[:1 + int(len(words) * rng.random() ** 3)]) for _ in range(rng.randint(0, 120))]
        docs.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in pick)))
    return docs


def test_equals_brute_force(spark):
    # Few letters make repeated and overlapping bigrams, ties of frequency, and very many near words.
    for seed, letters, length in ((1, "ab", (5, 9)), (2, "abcdeé×", (5, 8)), (3, "abcdefghijklmnopqrstuvwxyzÀÿ", (4, 14))):
        docs = corpus(seed, letters, length)
        df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA)
        assert got(df) == brute(docs)


def test_nulls_repeated_rows_long_texts_and_clashing_names(spark):
    docs = [(None, "Hellos hello, HELLO"), (None, "Hellos hello, HELLO"), (1, None), (2, ""), (3, "hellos " * 4000 + "jello " * 3), (3, "ab cd")]
    df = spark.createDataFrame([(i, t, "other", 5) for i, t in docs], SCHEMA)
    assert got(df) == brute(docs) != {}
    assert got(df.limit(0)) == {}


def test_pivots_are_the_lightest_disjoint_bigrams(spark):
    docs = corpus(5, "abcdef", (5, 11))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA)
    sets = spelling.grams(spelling.vocabulary(spelling.occurrences(df))).collect()
    assert len(sets) > 50
    for r in sets:
        assert len(r.prefix) >= 3 and len(r.pivots) == 2
        pairs = [(a.often + b.often) for a in r.prefix for b in r.prefix if a.p + 2 <= b.p]
        assert r.pivots[0].p + 2 <= r.pivots[1].p and sum(g.often for g in r.pivots) == min(pairs)


def test_words_that_share_a_bigram_alone_do_not_meet(spark):
    # All words begin alike; the key also holds half of the letters behind, so groups stay small.
    rng = random.Random(7)
    words = {"qx" + "".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(1500)}
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    sets = spelling.grams(df)
    x, y = spelling._keyed(sets, "pivots"), spelling._keyed(sets, "prefix")
    met = x.alias("x").join(y.alias("y"), "key").where("x.word <> y.word").count()
    assert met < len(words) * 60


def test_only_the_bigrams_are_broadcast(spark, monkeypatch):
    plans, stored = {}, spelling.stored

    def told(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name)

    monkeypatch.setattr(spelling, "stored", told)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in corpus(5, "abcdef", (5, 11))], SCHEMA)
    told(spelling.judge(df), "result")
    assert "BroadcastHashJoin" in plans.pop("spelling-sets")
    assert {"spelling-pairs", "spelling-forms", "spelling-steps-1", "result"} < plans.keys()
    for name, plan in plans.items():
        assert "Broadcast" not in plan, name
        assert "SortMergeJoin" in plan or name not in ("spelling-pairs", "spelling-forms", "spelling-steps-1", "result")
