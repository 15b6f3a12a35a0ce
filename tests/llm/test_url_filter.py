import random

import pytest
from pyspark.sql import functions as F

from prismframe.llm.url_filter import bloom_blocks, canonical_url, filter_urls

CASES = {
    "http://WWW.Example.com:80/a/b/?utm_source=x&id=3&ref=y#top": "example.com/a/b?id=3",
    "https://m.example.com/a/": "example.com/a",
    "https://example.com": "example.com",
    "https://example.com/?ref=1": "example.com",
    "https://example.com/?a=1&&b=2&": "example.com?a=1&b=2",
    "https://example.com/A?a=1&utm_x=2&b=3": "example.com/A?a=1&b=3",
    "https://u:p@example.com:8080/x": "example.com:8080/x",
    " https://example.com/x ": "example.com/x",
    "no scheme": "no scheme",
    "": "",
}


@pytest.mark.parametrize("url", CASES)
def test_canonical(spark, url):
    assert spark.createDataFrame([(url,)], "u string").select(canonical_url(F.col("u"))).first()[0] == CASES[url]


def test_no_listed_url_is_lost_and_no_other_passes(spark):
    rng = random.Random(1)
    listed = [f"http://h{rng.randint(0, 30)}.org/p{rng.randint(0, 300)}" for _ in range(500)]
    pages = [(i, f"https://www.h{rng.randint(0, 30)}.org/p{rng.randint(0, 300)}/?utm_source=z", "c") for i in range(3000)]
    known = {u[7:] for u in listed}
    want = {i for i, u, _ in pages if u[12:].split("/?")[0] in known}
    out = filter_urls(spark.createDataFrame(pages, "page_id long, url string, canonical string"), spark.createDataFrame([(u,) for u in listed], "url string"))
    assert {r.page_id for r in out.collect()} == want and len(want) > 50


def test_blocks_hold_every_key(spark):
    keys = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    blocks = bloom_blocks(keys, "k", 125)
    bits = sum(bin(v & (1 << 64) - 1).count("1") for r in blocks.collect() for v in (r.w0, r.w1, r.w2, r.w3))
    assert blocks.count() <= 125 and 0.2 < bits / (125 * 256) < 0.6


def test_edges(spark):
    pages = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "http://a.org/x", 0), (3, "http://a.org/x", 0), (None, "http://a.org/x/", 0), (5, "http://a.org/" + "y" * 100000, 0)], "page_id long, url string, block long")
    listed = spark.createDataFrame([("https://www.a.org/x",), (None,), ("",), ("http://a.org/" + "y" * 100000,)], "url string")
    got = [r.page_id for r in filter_urls(pages, listed).collect()]
    assert sorted(map(str, got)) == ["3", "3", "5", "None"]
    assert filter_urls(pages, listed.filter("false")).count() == 0 and filter_urls(pages.filter("false"), listed).count() == 0


def test_clashing_names_and_empty_pages(spark):
    pages = spark.createDataFrame([(1, "http://A.org/x", "c", 7), (2, None, "c", 7), (3, "", "c", 7)], "page_id long, url string, canonical string, w0 long")
    listed = spark.createDataFrame([("HTTP://a.org/x", "k")], "url string, block string")
    assert [r.page_id for r in filter_urls(pages, listed).collect()] == [1]
    assert filter_urls(pages.filter("false"), listed).count() == 0 and filter_urls(pages, listed.filter("false")).count() == 0
