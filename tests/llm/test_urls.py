from pyspark.sql import functions as F

from tidemark.llm import urls

PAGE = "page_id bigint, url string, host string, rule string"
LABEL = "doc_id bigint, quality int, toxic int, host string"
URLS = {
    1: ("http://A.Example.COM/en/1?x=/y", "a.example.com", "/en/1", "example.com/en/", "block"),
    2: ("https://www.example.com/en/2.html#t", "www.example.com", "/en/2.html", "www.example.com/en/", "allow"),
    3: ("https://x.www.example.com/en/", "x.www.example.com", "/en/", "www.example.com/en/", "allow"),
    4: ("ftp://b.net/es/4", "b.net", "/es/4", "net/es/", "block"),
    5: ("http://b.net/ES/4", "b.net", "/ES/4", None, "allow"),
    6: ("http://notexample.com/en/9", "notexample.com", "/en/9", "com/", "allow"),
    7: ("http://example.com", "example.com", "", None, "allow"),
    8: ("http://example.com?q=://z/", "example.com", "", None, "allow"),
    9: ("no scheme", "", "", None, "allow"), 10: (None, "", "", None, "allow"), 11: ("", "", "", None, "allow"),
    12: ("a://b://c/d", "b:", "//c/d", None, "allow"), 13: ("http://net/fr/x", "net", "/fr/x", "net/fr/", "block"),
    14: ("http://É.ORG:80/en/1", "É.org:80", "/en/1", None, "allow"), 15: ("http://x.org/\nen", "x.org", "/\nen", None, "allow"),
}


def test_rules_hosts_and_paths(spark):
    pages = spark.createDataFrame([(i, u[0], "h", "r") for i, u in URLS.items()] + [(9, "no scheme", "h", "r")], PAGE)
    got = [tuple(r) for r in urls.judge(pages, spark.createDataFrame([], LABEL)).collect()]
    want = [(i, *u[1:]) for i, u in URLS.items()] + [(9, *URLS[9][1:])]
    assert sorted(got) == sorted(want)
    assert urls.judge(pages.limit(0), spark.createDataFrame([], LABEL)).collect() == []


def test_reputation_shrinks_to_the_domain_and_blocks_by_the_bound(spark):
    pages, labels = [], []
    def add(host, good, bad, other=1):
        for k in range(good + bad + other):
            i = len(pages)
            pages.append((i, f"http://{host}/en/{i}/", "h", "r"))
            if k < good + bad:
                labels.append((i, int(k < good), 0, "h"))
    for k in range(20):
        add(f"h{k}.fine.org", 9, 1)
        add(f"h{k}.foul.org", 1, 14)
    add("new.foul.org", 0, 0, 1)
    add("new.fine.org", 0, 0, 1)
    add("one.fine.org", 0, 2, 1)
    labels += [(0, 1, 0, "h"), (None, 0, 1, "h"), (3, None, None, "h")]
    out = urls.judge(spark.createDataFrame(pages, PAGE), spark.createDataFrame(labels, LABEL)).select("host", "verdict").distinct().collect()
    verdict = dict(map(tuple, out))
    assert {verdict[f"h{k}.foul.org"] for k in range(20)} == {"block"} and {verdict[f"h{k}.fine.org"] for k in range(20)} == {"allow"}
    assert verdict["new.fine.org"] == "allow" and verdict["one.fine.org"] == "allow" and verdict["new.foul.org"] == "block"


def test_registered_domains(spark):
    hosts = {"a.b.example.co.uk": ("example.co.uk", "co.uk"), "x.org:80": ("x.org", "org"), "net": ("net", "net"), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    domain, suffix = urls.domain_of(F.col("host"))
    assert {r.host: (r.d, r.s) for r in df.select("host", domain.alias("d"), suffix.alias("s")).collect()} == hosts


def test_no_python_in_the_plan(spark):
    plan = urls.judge(spark.createDataFrame([], PAGE), spark.createDataFrame([], LABEL))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow"))
