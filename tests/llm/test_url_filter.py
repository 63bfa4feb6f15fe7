import math
import re
from collections import Counter

import pytest
from lotline.llm import queries, url_filter
from pyspark.sql import functions as F

ODD_URLS = [None, "", "no scheme", "http://", "HTTP://A.NET", "http://a.net/", "http://net/x", "http://xnet/", "https://Sub.Example.NET/en/x?q=1#f", "http://example.net/en",
            "http://example.com/de/1", "http://badexample.com/de/1", "http://a.example.com/de/", "http://x.org/fr/", "http://org/fr/?a=/en/", "x://y://z.net/", "http://u.net#/", "http://u.net?/",
            "http://ÀB.net/é", "http://h/" + "p" * 20_000, "http://a.net/\nb"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def check(got, urls):
    assert len(got) == len(urls)
    for r in got:
        host, path = parts(urls[r.page_id])
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))


@pytest.fixture(scope="module")
def model(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    return url_filter.train(url_filter.labelled_by_rules(pages, queries.RULES).filter(F.pmod(F.xxhash64("url"), F.lit(5)) != 0))


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    check(queries.op7_url_filter(spark, "/root/testdata/sf0.01").collect(), {r.page_id: r.url for r in pages.collect()})


def test_odd_urls(spark, model):
    df = spark.createDataFrame(list(enumerate(ODD_URLS)) + [], "page_id long, url string").withColumns({"host": F.lit(1), "score": F.lit("x"), "prediction": F.lit(2), "_url": F.lit(3)})
    check(url_filter.filter_urls(df, queries.RULES, model).collect(), dict(enumerate(ODD_URLS)))
    assert url_filter.filter_urls(df.limit(0), queries.RULES, model).count() == 0


def test_held_out_accuracy(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    held = url_filter.labelled_by_rules(pages, queries.RULES).filter(F.pmod(F.xxhash64("url"), F.lit(5)) == 0)
    right, blocked = model.score(held.withColumnRenamed("url", "_url")).agg(
        F.avg(((F.col("_score") >= 0.5) == F.col("block")).cast("double")), F.avg(F.col("block").cast("double"))).first()
    # the rules look at the path's language, which lexical features only see in part
    assert right > 0.7 and right > max(blocked, 1 - blocked) + 0.05


def test_lexical_patterns_are_learned(spark):
    """Labels that depend on digits and parameters, not on the suffix."""
    rows = [(f"http://h{i % 7}.example.com/p/{'9' * (i % 5)}?{'&'.join(f'a{k}=1' for k in range(i % 4))}", i % 5 > 2 or i % 4 > 2) for i in range(600)]
    model = url_filter.train(spark.createDataFrame(rows, "url string, block boolean"))
    got = model.score(spark.createDataFrame(rows, "_url string, block boolean")).agg(F.avg(((F.col("_score") >= 0.5) == F.col("block")).cast("double"))).first()[0]
    assert got > 0.95


def test_features(spark):
    url = "https://a-b.example.com/x1/y?p=1&q=2#f"
    host, path = url_filter.host_and_path(F.lit(url))
    got = spark.range(1).select(*[c.alias(k) for k, c in url_filter.features(F.lit(url), host, path).items()]).first()
    bits = -sum(n / len(url) * math.log2(n / len(url)) for n in Counter(url).values())
    assert (got.length, got.depth, got.labels, got.parameters, got.hyphens, got.fragment) == (len(url), 2, 3, 2, 1, 1)
    assert got.digit_ratio == pytest.approx(3 / len(url)) and got.entropy == pytest.approx(bits)


def test_one_kind_of_label(spark):
    df = spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")
    for labels, want in (([], "allow"), ([("http://x.y/", True)], "block"), ([("http://x.y/", False), (None, True)], "allow")):
        model = url_filter.train(spark.createDataFrame(labels, "url string, block boolean"))
        assert [r.verdict for r in url_filter.filter_urls(df, [], model).collect()] == [want]


def test_suffixes_are_counted_over_all_rows(spark):
    """More suffixes than 500 and more rows than are drawn: every suffix has its own share and count."""
    df = spark.range(6000).select(F.format_string("http://h.s%d/%d", F.col("id") % 1500, F.col("id")).alias("url"), (F.col("id") % 1500 < 700).alias("block"))
    model = url_filter.train(df, max_rows=400)
    got = model.with_features(df.select(F.col("url").alias("_url"), "block")).select("block", "_f_suffix_share", "_f_suffix_count").distinct().collect()
    base = 700 / 1500
    assert {(r.block, round(r._f_suffix_share, 9), r._f_suffix_count) for r in got} == {(True, round((4 + 10 * base) / 14, 9), 4.0), (False, round(10 * base / 14, 9), 4.0)}


def test_one_hot_url(spark):
    """A URL with most of the labelled rows neither fills the sample nor hides the other label, whatever the draw."""
    hot = spark.range(9000).select(F.lit("http://hot.example.com/a").alias("url"), F.lit(False).alias("block"))
    rest = spark.range(1500).select(F.format_string("http://h%d.example.com/%s", F.col("id") % 5, F.when(F.col("id") % 3 == 0, F.repeat(F.lit("9"), 8)).otherwise(F.lit("page"))).alias("u"), "id")
    rest = rest.select(F.concat("u", F.lit("/"), F.col("id").cast("string")).alias("url"), (F.col("id") % 3 == 0).alias("block"))
    for seed in range(2):
        model = url_filter.train(hot.union(rest), max_rows=300, seed=seed)
        right = model.score(rest.withColumnRenamed("url", "_url")).agg(F.avg(((F.col("_score") >= 0.5) == F.col("block")).cast("double"))).first()[0]
        assert right > 0.9
