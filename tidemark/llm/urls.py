"""URL filter by host reputation.

Labelled pages of a host are successes and failures of a binomial whose rate is drawn from a beta distribution around
the rate of its registered domain, that one from the domain's suffix, and that one from all pages. How tightly each
level holds together is estimated from the spread of its groups (moments of the beta-binomial), so a host with few
labels goes by its domain and one with many by its own record. A host is blocked when the upper bound of its posterior
share of good pages lies below the limit. Rules on host and path come first; the longest that fits decides.

All of it is built-in column functions: counts are aggregated before the shuffle, and six numbers come to the driver.
A NULL url and one without ``://`` have an empty host and path, fit no rule, and are judged as a host like any other.
Labels that are NULL, or repeated for an id, count as one outcome at most: bad if any row says so. Without labels the
prior is even and blocks nothing. Repeated pages are all returned and all counted; extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, small, stored

#: (host, path, verdict)
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
LIMIT = 0.5  # share of good pages
Z = 1.645  # of the bound: one-sided 95 %
LEAST, MOST = 1.0, 1000.0  # labels that a prior may be worth
#: Suffixes of two labels under which names are registered; fixed values.
DOUBLE = ["ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "org.au", "org.uk"]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both NULL if none fits. Of equally long ones a block wins."""
    text = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[2] == "block")):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def domain_of(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix. A port is no part of them."""
    parts = F.split(F.regexp_replace(host, r":\d*$", ""), r"\.")
    two = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)), ".")
    wide = two.isin(DOUBLE)
    suffix = F.when(wide, two).otherwise(F.element_at(parts, -1))
    three = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 2, F.lit(1)), F.lit(3)), ".")
    return F.when(wide, three).otherwise(two), suffix


def _worth(groups: DataFrame, rate: float) -> float:
    """Labels that the mean of these groups is worth as a prior for one of them: Kleinman's moments."""
    n = F.col("n").cast("double")
    row = groups.where("n > 0").agg(
        F.count("*").alias("m"), F.sum(n).alias("n"), F.sum(n * n).alias("squares"),
        F.sum(n * (F.col("k") / n - rate) * (F.col("k") / n - rate)).alias("spread")).first()
    if row["m"] < 2:
        return MOST
    room = row["n"] - row["squares"] / row["n"] - (row["m"] - 1)
    tie = (row["spread"] / (rate * (1 - rate)) - (row["m"] - 1)) / room if room > 1e-9 else 0.0
    return min(max(1 / tie - 1, LEAST), MOST) if tie > 0 else MOST


def reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior of every host. ``outcomes``: ``host`` and ``bad`` (0, 1, or NULL for a page without label).

    Returns ``host``, ``n``, ``good`` (posterior mean) and ``upper`` (its bound)."""
    domain, suffix = domain_of(F.col("host"))
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum(1 - F.col("bad")), F.lit(0)).alias("k"))
    hosts = stored(hosts.select("*", domain.alias("domain"), suffix.alias("suffix")), "url-hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    rate = (total["k"] + 1) / (total["n"] + 2)
    by_suffix, by_domain, by_host = (_worth(g, rate) for g in (suffixes, domains, hosts))

    def mean(prior: Column, worth: float) -> Column:
        return (F.col("k") + prior * worth) / (F.col("n") + worth)

    suffixes = suffixes.select("suffix", mean(F.lit(rate), by_suffix).alias("of_suffix"))
    domains = domains.join(suffixes, "suffix").select("domain", "suffix", mean(F.col("of_suffix"), by_domain).alias("of_domain"))
    joined = hosts.join(domains, ["domain", "suffix"]).select("host", "n", "k", "of_domain")
    good = mean(F.col("of_domain"), by_host)
    upper = good + Z * F.sqrt(good * (1 - good) / (F.col("n") + by_host + 1))
    return joined.select("host", "n", good.alias("good"), upper.alias("upper"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES, limit: float = LIMIT) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    The outcome of a page is the label of the document that its path names by number; it is bad if that document is of
    low quality or toxic.
    """
    host, path = split_url(pages["url"])
    rows = pages.select(pages["page_id"].alias("page_id"), host.alias("host"), path.alias("path"))
    named = F.regexp_extract("path", r"/([0-9]{1,18})(?:\.html?)?/?$", 1)
    ids = rows.select("host", F.when(named != "", named.cast("bigint")).alias("doc_id"))
    worse = [F.when(c.isNull(), None).otherwise(c.cast("int")) for c in (labels["quality"] == 0, labels["toxic"] == 1)]
    known = labels.select("doc_id", F.greatest(*worse).alias("bad")).where("doc_id is not null")
    known = known.groupBy("doc_id").agg(F.max("bad").alias("bad"))
    hosts = stored(reputation(ids.join(known, "doc_id", "left").select("host", "bad")), "url-reputation")
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("upper") < limit, "block").otherwise("allow")
    return rows.join(small(hosts.select("host", "upper")), "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(ruled, own).alias("verdict"))


def _rules_sql(rules: list[tuple[str, str, str]], what: int | None) -> str:
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "block"))
    return "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p if what is None else v}'"
        for h, p, v in ordered) + " END"


def _worth_sql(groups: str) -> str:
    return f"""SELECT CASE WHEN count(*) < 2 OR sum(n) - sum(n * n) / sum(n) - (count(*) - 1) <= 1e-9 THEN {MOST} ELSE
    (SELECT CASE WHEN tie > 0 THEN least(greatest(1 / tie - 1, {LEAST}), {MOST}) ELSE {MOST} END FROM
      (SELECT (sum(n * (k / n - rate) * (k / n - rate)) / any_value(rate * (1 - rate)) - (count(*) - 1))
        / (sum(n) - sum(n * n) / sum(n) - (count(*) - 1)) AS tie FROM {groups}, total WHERE n > 0)) END AS worth
    FROM {groups} WHERE n > 0"""


_DOUBLE_SQL = ", ".join(f"'{d}'" for d in DOUBLE)
ORACLE = f"""
WITH rest AS (
  SELECT page_id, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END, '') AS r FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), known AS (
  SELECT doc_id, max(greatest((quality = 0)::INT, (toxic = 1)::INT)) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), outcomes AS (
  SELECT host, bad FROM p LEFT JOIN known ON doc_id = try_cast(regexp_extract(path, '/([0-9]{{1,18}})(\\.html?)?/?$', 1) AS BIGINT)
), h0 AS (
  SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(1 - bad), 0)::DOUBLE AS k,
    string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS parts FROM outcomes GROUP BY host
), h1 AS (
  SELECT *, array_to_string(parts[greatest(len(parts) - 1, 1):], '.') AS two FROM h0
), h AS (
  SELECT host, n, k, CASE WHEN two IN ({_DOUBLE_SQL}) THEN array_to_string(parts[greatest(len(parts) - 2, 1):], '.') ELSE two END AS domain,
    CASE WHEN two IN ({_DOUBLE_SQL}) THEN two ELSE parts[-1] END AS suffix FROM h1
), d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY domain, suffix),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY suffix),
total AS (SELECT (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) AS rate FROM h),
ws AS ({_worth_sql('s')}), wd AS ({_worth_sql('d')}), wh AS ({_worth_sql('h')}),
ms AS (SELECT suffix, (k + rate * worth) / (n + worth) AS m FROM s, total, ws),
md AS (SELECT domain, d.suffix, (d.k + m * worth) / (d.n + worth) AS m FROM d JOIN ms USING (suffix), wd),
g AS (SELECT host, n, worth, (k + m * worth) / (n + worth) AS good FROM h JOIN md USING (domain, suffix), wh),
u AS (SELECT host, good + {Z} * sqrt(good * (1 - good) / (n + worth + 1)) AS upper FROM g)
SELECT page_id, host, path, {_rules_sql(RULES, None)} AS rule,
  coalesce({_rules_sql(RULES, 2)}, CASE WHEN upper < {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN u USING (host)
"""
