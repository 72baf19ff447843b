"""Spelling variants by pivotal grams: words one edit apart, and the frequent form each word goes back to.

Words are counted over whole texts. Every word is cut into its bigrams, which stand in one order for all words: rare
ones first. A word's gram prefix holds its three rarest bigrams (and more where the third is tied); of these, dynamic
programming picks two disjoint ones of the least total frequency, its pivots. One edit spares at least one pivot of a
word, and of two words one edit apart, a spared pivot of the one with the smaller prefix end is in the other's prefix.
So pivots are joined with prefixes. The position limits are exact: what stands left of a spared gram is the same in both
words, or what stands right of it is; and of the other side, where the edit is, the first or the last half is the same
too. All of these are in the join key, so a group holds only words that agree in more than half of their letters, however
many words share a bigram. What meets is verified by edit distance.

Counts are aggregated before the shuffle, so a word with a third of all occurrences costs each task one row. Only the
bigrams are broadcast: there are 8,100 at most, of 90 letters. All other joins shuffle, whatever sizes Spark expects: it
takes stored files for as small as they are compressed and does not see that keys are several dozen times as many as words.
All of it is built-in functions.

A NULL text has no words; a NULL id counts as empty in what decides deletions. Rows are read one by one: repeated rows
count twice, ties and other columns do not matter, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, stored

LEAST_LENGTH, LEAST_COUNT = 5, 3  # the method needs four bigrams, so no word may be shorter than five
RATIO = 2  # how many times as frequent a form is as the word that goes back to it
SPELT_WRONG = 97  # one occurrence in so many loses a letter


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int | None = None) -> DataFrame:
    """``word`` of every run of letters of five or more, lower-cased. With ``one_in``, runs whose CRC-32 with the id is a
    multiple of it lose the letter at that number modulo their length."""
    runs = F.split(ascii_lower(docs[text_col]), r"[^a-zÀ-ÿ]+")
    each = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    each = each.where(F.length("run") >= LEAST_LENGTH)
    if one_in is None:
        return each.select(F.col("run").alias("word"))
    each = each.withColumn("crc", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("crc") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return each.select(F.when(F.col("crc") % one_in == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame) -> DataFrame:
    """``word`` and ``n`` of the words that are long and frequent enough."""
    counted = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def grams(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``prefix`` and ``pivots`` (arrays of ``rank``, ``n`` and ``p``), and ``last``, the prefix's end."""
    places = F.explode(F.sequence(F.lit(0), F.length("word") - 2)).alias("p")
    each = words.select("word", places).withColumn("gram", F.substring("word", F.col("p") + 1, F.lit(2)))
    counted = each.groupBy("gram").agg(F.count("*").alias("often"))
    ranks = counted.select("gram", "often", F.row_number().over(Window.orderBy("often", "gram")).alias("rank"))
    ranks = F.broadcast(stored(ranks, "spelling-grams"))  # 8,100 rows at most
    sets = words.select("word", "n", places).withColumn("gram", F.substring("word", F.col("p") + 1, F.lit(2))).join(ranks, "gram")
    sets = sets.groupBy("word", "n").agg(F.sort_array(F.collect_list(F.struct("rank", "often", "p"))).alias("all"))
    sets = sets.withColumn("last", F.col("all")[2]["rank"])
    prefix = F.expr("array_sort(filter(all, g -> g.rank <= last), (a, b) -> a.p - b.p)")
    sets = sets.select("word", "n", "last", prefix.alias("prefix"))
    return sets.withColumn("pivots", _lightest_pair(F.col("prefix")))


def _lightest_pair(prefix: Column) -> Column:
    """Two bigrams that do not overlap, of the least total frequency; of equals the pair that ends first.

    The fold goes by position. It holds the lightest bigram so far, the last one, which may overlap the next, and the best
    pair."""
    none = F.struct(F.lit(1 << 60).alias("often"), F.lit(-9).alias("p"))
    one = lambda g: F.struct(g["often"].alias("often"), g["p"].alias("p"))

    def step(s: Column, g: Column) -> Column:
        before = F.when(s["last"]["p"] <= g["p"] - 2, F.least(s["light"], s["last"])).otherwise(s["light"])
        pair = F.struct((before["often"] + g["often"]).alias("often"), before["p"].alias("p"), g["p"].alias("q"))
        return F.struct(F.least(s["light"], s["last"]).alias("light"), one(g).alias("last"), F.least(s["best"], pair).alias("best"))

    start = F.struct(none.alias("light"), none.alias("last"), F.struct(F.lit(1 << 61).alias("often"), F.lit(-9).alias("p"), F.lit(-9).alias("q")).alias("best"))
    best = F.aggregate(prefix, start, step, lambda s: s["best"])
    return F.filter(prefix, lambda g: (g["p"] == best["p"]) | (g["p"] == best["q"]))


def _keyed(sets: DataFrame, which: str) -> DataFrame:
    """One row per gram and way in which a word one edit apart can agree around it: ``key``, ``m`` letters on the edited
    side, ``shorter``, the fewer of the two words there."""
    each = sets.select("word", "n", "last", F.explode(which).alias("g")).select("word", "n", "last", "g.p")
    # The same letters on the left of the gram ('L') or on its right ('R'), and the m letters of the other side.
    sides = F.expr("""explode(array(
        struct('L' as side, p as place, substring(word, 1, p + 2) as same, substring(word, p + 3) as other),
        struct('R' as side, length(word) - p as place, substring(word, p + 1) as same, substring(word, 1, p) as other)))""")
    each = each.select("word", "n", "last", sides.alias("s")).select("word", "n", "last", "s.*", F.length("s.other").alias("m"))
    each = each.withColumn("shorter", F.explode(F.expr("filter(array(m, m - 1), x -> x >= 0)"))).withColumn("h", F.expr("shorter div 2"))
    # One edit leaves the first h of the other side's letters or the last shorter - h.
    halves = F.expr("""explode(filter(array(
        struct('first' as half, substring(other, 1, h) as letters),
        struct('last' as half, substring(other, m - (shorter - h) + 1) as letters)), x -> h > 0 or x.half = 'first'))""")
    each = each.select("*", halves.alias("x"))
    key = F.xxhash64("side", "place", "same", "shorter", "x.half", "x.letters")
    return each.select(key.alias("key"), "word", "n", "last", "m", "shorter")


def near_words(words: DataFrame) -> DataFrame:
    """``a`` < ``b`` one edit apart, with their counts ``na`` and ``nb``, each pair once. ``words`` is a stored vocabulary."""
    sets = stored(grams(words), "spelling-sets")
    x, y = _keyed(sets, "pivots").alias("x"), _keyed(sets, "prefix").alias("y")
    on = (F.col("x.key") == F.col("y.key")) & (F.col("x.last") <= F.col("y.last")) & (F.col("x.word") != F.col("y.word"))
    on &= (F.col("x.m") == F.col("x.shorter")) | (F.col("y.m") == F.col("x.shorter"))
    met = x.join(y.hint("merge"), on).where(F.levenshtein(F.col("x.word"), F.col("y.word"), 1) == 1)
    one, two = F.struct("x.word", "x.n"), F.struct("y.word", "y.n")
    pairs = met.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b"))
    return pairs.select(F.col("a.word").alias("a"), F.col("a.n").alias("na"), F.col("b.word").alias("b"), F.col("b.n").alias("nb")).distinct()


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``n``, ``n_near``, and ``form`` and ``form_n`` where a near word is frequent enough, else NULL."""
    pairs = stored(near_words(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), "b", "nb").unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("b"), F.col("na").alias("nb")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("nb")).alias("less"), F.col("b"))).alias("best"))
    met = words.join(best.hint("merge"), "word", "left").withColumn("form_n", -F.col("best.less"))
    goes = F.col("form_n") >= ratio * F.col("n")
    return met.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(goes, F.col("best.b")).alias("form"), F.when(goes, F.col("form_n")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """Add ``root``, the end of the chain of forms, by doubling the steps each round.

    Counts at least double along a chain, so it has no cycle and at most as many steps as a count has bits."""
    steps = stored(formed.where("form is not null").select("word", F.col("form").alias("root")), "spelling-steps-0")
    turn = 0
    while True:
        turn += 1
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        onward = steps.join(onward.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        onward = stored(onward, f"spelling-steps-{turn}")
        steps = onward.select("word", "root")
        if onward.where("moved").isEmpty():
            break
    return formed.join(steps.hint("merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    words = stored(vocabulary(occurrences(docs, id_col, text_col, SPELT_WRONG)), "spelling-words")
    return roots(stored(forms(words), "spelling-forms")).select("word", "form", "root", "n", "n_near", "form_n")


# Near words by deletion: the same word with one letter less, or two words with the same letter left out.
ORACLE = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, i)) AS t
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), each_run AS (
  SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS h FROM runs WHERE length(run) >= 5 GROUP BY id, run
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
      list_transform(range(length(h) // 2), lambda i: CAST(16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1 AS BIGINT)),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), CAST(4294967295 AS BIGINT))) AS crc
  FROM each_run, crc
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN crc % 97 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, CAST(crc % length(run) + 2 AS BIGINT)) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS v FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.v = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.v = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 2 * w.n THEN b.m END AS form_n,
    CASE WHEN b.m >= 2 * w.n THEN (SELECT min(x.other) FROM near x WHERE x.word = w.word AND x.m = b.m) END AS form
  FROM words w LEFT JOIN best b USING (word)
), walk AS (
  SELECT word, word AS at, form AS onward FROM formed
  UNION ALL SELECT k.word, f.word, f.form FROM walk k JOIN formed f ON k.onward = f.word
)
SELECT f.word, f.form, k.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN walk k ON k.word = f.word AND k.onward IS NULL
"""
