import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gondola.llm import registry, url_filter

SF = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def judged(url, rules, forms, form):
    """Plain version: (host, path, rule, verdict)."""
    host, path = parts(url)
    fits = [] if url is None or "://" not in url else [
        (len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        *_, verdict, rule = max(fits)
        return host, path, rule, verdict
    return host, path, None, "block" if form in forms else "allow"


@pytest.fixture(scope="module")
def tables(spark):
    rules = lambda rows: spark.createDataFrame(rows, "host string, path string, verdict string")
    urls = lambda rows: spark.createDataFrame([(u,) for u in rows], "url string")
    return rules, urls


URLS = ["http://a.example.net/en/1", "http://a.example.net/EN/1", "https://Example.NET/en/", "http://badexample.net/en/2", "http://x.net", "http://x.net/",
        "http://net/", "http://a.org/fr/x?y=1#z", "http://a.org/fr", "http://b.example.com/de/9", "http://b.example.com?/de/", "ftp://q.com#/a",
        "no scheme/en/", "", None, "http://", "://net/", "http://a://b.net/x", "http://u:p@h.net:80/z", "http://.net/a", "http://a.b.c.d.example.net/en/q",
        "http://é.net/ü/ü", "http://list.com/a/?b=2&a=1&utm_source=q#f", "https://LIST.com:443/a?a=1&b=2", "http://list.com/A?a=1&b=2",
        "http://a\n.net/x\ny", "http://very.long/" + "x" * 200_000]


@pytest.mark.parametrize("max_blocks", [1, 1 << 18])
def test_rules_and_list_against_plain_version(spark, tables, max_blocks):
    make_rules, urls = tables
    rules = url_filter.RULES + [("example.net", "/en/1", "block"), ("a.example.net", "/en/1", "allow"), ("net", "/x", "allow"), ("net", "/x", "block"),
                                ("é.net", "/ü/", "allow"), ("UPPER.net", "/", "allow"), (None, "/", "block"), ("c.d.example.net", "", "block")]
    listed = ["http://list.com/a?b=2&a=1", None, "nothing", "http://a.b.c.d.example.net/en/q", "http://very.long/" + "x" * 200_000]
    pages = urls(URLS * 2)
    formed = urls(URLS + listed).withColumn("f", url_filter.canonical(F.col("url")))
    forms = {r["url"]: r["f"] for r in formed.collect()}
    in_list = {forms[u] for u in listed} - {None}
    plain = [(h.lower() if h else h, p, v) for h, p, v in rules if h is not None]
    expected = Counter((u, *judged(u, plain, in_list, forms[u])) for u in URLS * 2)
    got = Counter(tuple(r) for r in url_filter.judge(pages, make_rules(rules), urls(listed), max_blocks).select("url", "host", "path", "rule", "verdict").collect())
    assert got == expected


def test_canonical_form(spark):
    pairs = {"http://LIST.com:80/a//?utm_medium=x&b=2&a=1&&ref=q#f": "list.com/a?a=1&b=2", "https://list.com./": "list.com",
             "http://h:8080/A?reference=1": "h:8080/A?reference=1", "x": None, None: None, "http://": ""}
    got = spark.createDataFrame([(u,) for u in pairs], "url string").select("url", url_filter.canonical(F.col("url")).alias("f"))
    assert dict(tuple(r) for r in got.collect()) == pairs


def test_empty_tables_and_clashing_columns(spark, tables):
    make_rules, urls = tables
    some, none = urls(["http://x.net/a"]), urls(["q"]).limit(0)
    no_rules = make_rules(url_filter.RULES).limit(0)
    assert url_filter.judge(none, make_rules(url_filter.RULES), some).count() == 0
    assert [tuple(r) for r in url_filter.judge(some, no_rules, none).collect()] == [("http://x.net/a", "x.net", "/a", None, "allow")]
    clash = some.selectExpr("url", "'h' AS HOST", "1 AS rule", "2 AS `a.b`", "3 AS key", "4 AS block", "5 AS word")
    got = url_filter.judge(clash, make_rules(url_filter.RULES), none)
    assert got.columns == ["url", "a.b", "key", "block", "word", "host", "path", "rule", "verdict"]
    assert tuple(got.collect()[0]) == ("http://x.net/a", 2, 3, 4, 5, "x.net", "/a", "net/", "block")


def test_filter_loses_no_key_and_stays_bounded(spark):
    keys = spark.range(5000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("key"))
    for limit in (1, 64, 1 << 18):
        bloom, blocks = url_filter.bloom_filter(keys, limit)
        assert blocks <= limit and bloom.count() <= blocks
        assert url_filter.possible_hits(keys, bloom, blocks).count() == 5000
    others = spark.range(100_000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("key"))
    assert url_filter.possible_hits(others, bloom, blocks).count() < 10_000  # 16 bits a key


def test_query_blocks_repeat_visits_without_a_rule(spark, tmp_dir):
    rows = [(0, "http://a.com/x?utm_source=1"), (1, "https://a.com/x/"), (2, "http://a.com/y"), (3, "http://b.net/"), (None, None)]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(f"{tmp_dir}/pages.parquet")
    got = {tuple(r) for r in registry.QUERIES["op13_url_filter"](spark, tmp_dir).select("page_id", "rule", "verdict").collect()}
    assert got == {(0, None, "block"), (1, None, "block"), (2, None, "allow"), (3, "net/", "block"), (None, None, "allow")}


def test_no_python_in_the_plan(spark):
    plan = registry.QUERIES["op13_url_filter"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
