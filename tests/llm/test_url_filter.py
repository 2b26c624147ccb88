"""URL verdicts: rules, the Bloom filter's promise, and a plan without Python."""

from farebox.llm import url_filter
from farebox.llm.url_filter import blocked_bloom, canonical, host_of, path_of, url_verdicts
from pyspark.sql import functions as F

CASES = {
    "http://A.Example.NET/en/x?y#z": ("a.example.net", "/en/x", "example.net/en/", "allow"),
    "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
    "https://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"),
    "ftp://net/": ("net", "/", "net/", "block"),
    "http://x.net": ("x.net", "", None, "allow"),
    "http://x.net?a/b://c": ("x.net", "", None, "allow"),
    "http://m.example.com/de/1": ("m.example.com", "/de/1", "example.com/de/", "block"),
    "http://example.com/DE/1": ("example.com", "/DE/1", None, "allow"),
    "http://é.org/fr/": ("é.org", "/fr/", "org/fr/", "allow"),
    "no scheme.net/": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "://": ("", "", None, "allow"),
    "http://www.bad.com/a/?utm_source=q&b=2&a=1": ("www.bad.com", "/a/", None, "block"),
    "https://bad.com/a?a=1&b=2#frag": ("bad.com", "/a", None, "block"),
    "https://bad.com/A?a=1&b=2": ("bad.com", "/A", None, "allow"),
}


def frames(spark):
    rows = list(enumerate(CASES))
    return (spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS rule", "2 AS w0"),
            spark.createDataFrame([("http://bad.com/a?b=2&a=1&ref=z",), ("http://bad.com/a?b=2&a=1",), (None,), ("junk",)], "url string"))


def test_verdicts(spark):
    pages, listed = frames(spark)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(pages, listed).collect()}
    assert got == {i: want for i, want in enumerate(CASES.values())}


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    pages, listed = frames(spark)
    want = sorted(map(str, url_verdicts(pages, listed).collect()))
    noise = spark.range(3000).selectExpr("concat('http://site', id, '.info/', id) AS url")
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", 1)
    assert sorted(map(str, url_verdicts(pages, listed.unionByName(noise)).collect())) == want


def test_no_listed_url_is_missed_and_few_others_pass(spark):
    urls = spark.range(20000).select(F.concat(F.lit("http://h"), F.col("id"), F.lit(".info/p")).alias("url"), "id")
    listed = urls.where("id % 4 = 0")
    names = listed.select(canonical(F.col("url")).alias("canonical"))
    blocks = 5000 * url_filter.PER_URL // 512 + 1
    block, masks = url_filter._place(F.col("canonical"), blocks)
    probed = urls.select("id", canonical(F.col("url")).alias("canonical")).withColumn("block", block)
    probed = probed.join(blocked_bloom(names, blocks), "block", "left")
    inside = F.lit(True)
    for i, mask in enumerate(masks):
        inside &= F.coalesce(F.col(f"w{i}").bitwiseAND(mask) == mask, F.lit(False))
    counts = {r.l: (r.n, r.hits) for r in probed.groupBy((F.col("id") % 4 == 0).alias("l")).agg(F.count("*").alias("n"), F.sum(inside.cast("int")).alias("hits")).collect()}
    assert counts[True] == (5000, 5000)
    assert counts[False][1] < 0.02 * counts[False][0]


def test_nothing_runs_in_python(spark):
    pages, listed = frames(spark)
    plan = url_verdicts(pages, listed)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "MapIn"))


def test_empty_sides_and_repeated_rows(spark):
    pages, listed = frames(spark)
    assert url_verdicts(pages.limit(0), listed).collect() == []
    assert {r.verdict for r in url_verdicts(pages.where("url LIKE '%bad%'"), listed.limit(0)).collect()} == {"allow"}
    assert url_verdicts(pages.unionByName(pages), listed.unionByName(listed)).count() == 2 * len(CASES)


def test_host_and_path_of_odd_urls(spark):
    df = spark.createDataFrame([("x://H:80/p://q?r",), ("a b://U@h/",)], "url string")
    got = df.select(host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p")).collect()
    assert [(r.h, r.p) for r in got] == [("h:80", "/p://q"), ("U@h".lower(), "/")]
