import pytest
from pyspark.sql import functions as F

from scorewright.llm import hot_keys
from scorewright.llm.queries import QUERIES
from scorewright.llm.url_filter import RULES, host_reputation, judge_urls

URLS = [("https://A.Example.ORG/en/2?x#y", "a.example.org", "/en/2", "org/", "allow"),
        ("http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
        ("http://b.example.org/es/1", "b.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/es", "example.org", "/es", "org/", "allow"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://x.org", "x.org", "", None, None),
        ("http://x.org?q=/", "x.org", "", None, None),
        ("http://x.com/fr/a://b", "x.com", "/fr/a://b", "com/fr/", "allow"),
        ("//x.com/de/", "", "", None, None),
        ("http://com/de/", "com", "/de/", "com/de/", "block"),
        ("http://x.org:80/a", "x.org:80", "/a", None, None),
        ("a\nb://x.com/de/\nc", "x.com", "/de/\nc", "com/de/", "block"),
        ("mailto:a", "", "", None, None), ("", "", "", None, None), (None, "", "", None, None),
        ("x:///de/", "", "/de/", None, None), ("http://x.net/de/", "x.net", "/de/", None, None)]


def test_rules_by_hand(spark):
    pages = spark.createDataFrame([(k, u[0]) for k, u in enumerate(URLS)], "page_id long, url string")
    rows = {r.page_id: r for r in judge_urls(pages).collect()}
    assert len(rows) == len(URLS)
    for k, (_, host, path, rule, verdict) in enumerate(URLS):
        r = rows[k]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def plain_reputation(outcomes, hosts):
    """Posteriors by dictionaries."""
    count = {h: [0, 0] for h in hosts}
    for h, bad in outcomes:
        count.setdefault(h, [0, 0])
        count[h][0] += 1
        count[h][1] += bad
    levels = [lambda h: h.split(".")[-1], lambda h: ".".join(h.split(".")[-2:]), lambda h: h]
    n, x = sum(c[0] for c in count.values()), sum(c[1] for c in count.values())
    mean = {None: (x + 1) / (n + 2) if n else 0.5}
    above = lambda g: None
    for level in levels:
        groups = {}
        for h, c in count.items():
            g = groups.setdefault(level(h), [0, 0, mean[above(h)]])
            g[0] += c[0]
            g[1] += c[1]
        seen = sum((b - a * m) ** 2 for a, b, m in groups.values())
        alone = sum(a * m * (1 - m) for a, b, m in groups.values())
        pairs = sum(a * (a - 1) * m * (1 - m) for a, b, m in groups.values())
        rho = (seen - alone) / pairs if pairs else 0
        k = min(max(1 / rho - 1, 1), 1000) if rho > 0 else 1000
        post = {g: (k * m + b, k * (1 - m) + a - b) for g, (a, b, m) in groups.items()}
        mean = {g: a / (a + b) for g, (a, b) in post.items()}
        above = level
    return post


def outcomes():
    rows = [("bad.spam.com", k % 20 > 0) for k in range(200)] + [("worse.spam.com", True)] * 30
    rows += [(f"h{k % 7}.fine.com", k % 9 == 0) for k in range(120)] + [("x.fine.net", False)] * 40 + [("y.mixed.net", k % 2 == 0) for k in range(60)]
    return rows


@pytest.mark.parametrize("share", [1000, 3])
def test_posterior_equals_plain(spark, monkeypatch, share):
    monkeypatch.setattr(hot_keys, "SHARE", share)
    hosts = ["new.spam.com", "new.fine.com", "new.net", "new.org", "", "bad.spam.com"]
    got = host_reputation(spark.createDataFrame(outcomes(), "host string, blocked boolean"),
                          spark.createDataFrame([(h,) for h in [*hosts, "new.net"]], "host string"))
    want = plain_reputation(outcomes(), hosts)
    rows = {r.host: (r.alpha, r.beta) for r in got.collect()}
    assert rows.keys() == want.keys() and got.count() == len(want)
    for h, (a, b) in want.items():
        assert rows[h] == pytest.approx((a, b), rel=1e-6)


def test_reputation_decides_unruled_pages(spark):
    urls = ["http://bad.spam.com/", "http://worse.spam.com/a", "http://h1.fine.com/", "http://unseen.net/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = judge_urls(pages, spark.createDataFrame(outcomes(), "host string, blocked boolean"), rules=[("allow", "nowhere/")])
    assert [r.verdict for r in out.orderBy("page_id").collect()] == ["block", "block", "allow", "allow"]
    none = judge_urls(pages, spark.createDataFrame([(None, True), ("x", None)], "host string, blocked boolean"), rules=RULES)
    assert {r.verdict for r in none.collect()} == {"allow"}


def test_edges(spark, folder):
    rows = [(1, "http://a.com/x", None), (1, "http://a.com/x", None), (None, None, "z"), (3, "http://a.com/fr/", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string").withColumn("row", F.lit(1)).withColumn("hit", F.lit(2))
    out = judge_urls(pages)
    assert out.columns == ["page_id", "url", "row", "hit", "host", "path", "rule", "verdict"] and out.count() == 4
    assert judge_urls(pages.limit(0)).collect() == []
    pages.limit(0).write.parquet(f"{folder}/pages.parquet")
    assert QUERIES["op12_url_filter"](spark, folder).collect() == []


def test_lookup_keeps_all_rows(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 900)).alias("k"))
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.length("k"))
    out = hot_keys.lookup(rows, table, "k", "n")
    assert out.count() == 5000 and out.filter("v <> length(k)").count() == 0
