from parcelflow.llm import bloom, url_filter


def _pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' AS verdict", "1 AS block", "2 AS rule")


def test_rules_and_list(spark):
    urls = [None, "nope", "http://A.NET?x", "HTTP://b.example.net/en/x#q", "x://net/", "x://foonet/", "http://a.org/fr/z?ref=1&b=2",
            "http://m.z.zz/a/?b=1&a=2&utm_x=3", "https://z.zz/a?a=2&b=1#f", "https://z.zz/b", "x://example.com/de/1", "x://example.com/d",
            "x://y.net/en/", "https://z.zz:443/b/", "://q.net/"]
    pages = _pages(spark, urls)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, url_filter.repeated_urls(pages)).collect()}
    assert got == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("a.net", "", None, "allow"),
        3: ("b.example.net", "/en/x", "example.net/en/", "allow"), 4: ("net", "/", "net/", "block"), 5: ("foonet", "/", None, "allow"),
        6: ("a.org", "/fr/z", "org/fr/", "allow"), 7: ("m.z.zz", "/a/", None, "block"), 8: ("z.zz", "/a", None, "block"),
        9: ("z.zz", "/b", None, "block"), 10: ("example.com", "/de/1", "example.com/de/", "block"), 11: ("example.com", "/d", None, "allow"),
        12: ("y.net", "/en/", "net/", "block"), 13: ("z.zz:443", "/b/", None, "block"), 14: ("q.net", "/", "net/", "block"),
    }


def test_bloom_has_no_false_misses_and_few_false_hits(spark, monkeypatch):
    keys = spark.range(0, 20_000, 2).selectExpr("CAST(id AS STRING) AS k")
    probes = spark.range(20_001).selectExpr("id", "IF(id = 20000, NULL, CAST(id AS STRING)) AS p")
    hits = bloom.with_possible(probes, "p", keys, "k").where("possible").selectExpr("id % 2 AS odd", "id").groupBy("odd").count()
    counts = {r.odd: r["count"] for r in hits.collect()}
    assert counts[0] == 10_000 and counts.get(1, 0) < 300
    monkeypatch.setattr(bloom, "MOST_BLOCKS", 8)
    crowded = bloom.with_possible(probes, "p", keys, "k").where("possible AND id % 2 = 0 AND id < 20000").count()
    assert crowded == 10_000


def test_empty_tables(spark):
    none = _pages(spark, []).limit(0)
    assert url_filter.filter_urls(none, url_filter.repeated_urls(none)).count() == 0
    one = _pages(spark, ["http://a.b/c"])
    assert url_filter.filter_urls(one, url_filter.repeated_urls(none)).first().verdict == "allow"
