import math

import pytest
from pyspark.sql import functions as F

from prismframe.functions import dates, hashing, stats, urls
from prismframe.functions import text as X


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()[0]


URLS = {
    "": "", None: "", "https://example.com/": "https://example.com/", "https://WWW.Example.com/a//?utm_source=x&id=2&Reference=1#f": "https://example.com/a?id=2",
    "http://m.example.com/x/": "http://example.com/x", "http://www.mobile.example.com": "http://example.com", "https://News.Google.com/rss/A?oc=5": "https://News.Google.com/rss/A",
    "https://e.com/p?a": "https://e.com/p?a=", "example.com/path": "example.com/path",
}


@pytest.mark.parametrize("url", list(URLS))
def test_canonical_url(spark, url):
    assert one(spark, url, urls.canonical_url) == URLS[url]


TITLES = {"!!!---???": "", "Talks resume - Reuters": "talks resume", "A | CNN | World News": "a", "L’été s'en va": "lété sen va", None: "", "한국 뉴스": "", "Победа — Lenta": "победа", "Well-Known": "well"}


@pytest.mark.parametrize("title", list(TITLES))
def test_normalise_title(spark, title):
    assert one(spark, title, X.normalise_title) == TITLES[title]


def test_sections(spark):
    for path, want in (("/opinion/x", "opinion"), ("/Blogs/a", "opinion"), ("/op-ed/a", "opinion"), ("/world/opinions", "news"), ("", "news")):
        assert one(spark, "https://e.com" + path, urls.infer_section) == want


def test_tokens(spark):
    got = one(spark, "The cities' stories about Glasses, Москва 東京都庁前 with uno", X.tokens)
    assert got == ["citi", "stor", "glass", "москва", "東京都庁前"]
    assert one(spark, None, X.tokens) == [] and one(spark, "news", X.tokens) == ["news"]


def test_signal_text(spark):
    def level(body, summary, title):
        r = spark.createDataFrame([(body, summary, title)], "b string, s string, t string").select(X.signal_text(F.col("b"), F.col("s"), F.col("t")).alias("x")).first().x
        return r.level, len(r.text)

    assert level("b" * 2000, "s" * 500, "t") == ("body", 2000)
    assert level("b" * 9000, "", "t") == ("body", 2500)
    assert level("short", "s" * 500, "t") == ("summary", 503)
    assert level(None, "s", "title") == ("title", 5) and level(None, None, None) == ("empty", 0)


def test_dates(spark):
    for text, want in (
        ("Thu, 06 Aug 2026 10:00:00 GMT", "2026-08-06 10:00:00"), ("Thu, 06 Aug 2026 10:00:00 +0200", "2026-08-06 08:00:00"), ("2026-08-06T10:00:00Z", "2026-08-06 10:00:00"),
        ("2026-08-06T10:00:00+02:00", "2026-08-06 08:00:00"), ("2026-08-06", "2026-08-06 00:00:00"), ("yesterday-ish", "None"), ("", "None"),
    ):
        assert str(one(spark, text, dates.parse_published)) == want
    now = F.lit("2026-08-06 00:00:00").cast("timestamp")
    assert one(spark, "2026-08-07", lambda c: dates.age_hours(dates.parse_published(c), now)) == -24.0
    assert one(spark, "?", lambda c: dates.within_days(c, 7, now)) is True and one(spark, "2026-01-01", lambda c: dates.within_days(c, 7, now)) is False


def test_tails(spark):
    assert one(spark, 1.96, stats.p_of_z, "double") == pytest.approx(math.erfc(1.96 / math.sqrt(2)))
    assert one(spark, None, stats.p_of_z, "double") is None
    assert stats.p_of_r_value(0.5, 10) == pytest.approx(0.14111, abs=1e-5)
    assert stats.p_of_r_value(0.5, 2) is None and stats.p_of_r_value(1.0, 9) == 0.0 and stats.p_of_r_value(0.0, 12) == pytest.approx(1.0)
    assert stats.incomplete_beta(2, 3, 0.4) == pytest.approx(0.5248)
    g = spark.createDataFrame([(10, 2, 100, 400)], "a int, b int, ta int, tb int").select(stats.g2(*map(F.col, ("a", "b", "ta", "tb")))).first()[0]
    cells = [(10, 12 * 100 / 500), (2, 12 * 400 / 500), (90, 488 * 100 / 500), (398, 488 * 400 / 500)]
    assert g == pytest.approx(2 * sum(o * math.log(o / e) for o, e in cells))
    low, high = stats.bootstrap_interval([1, 0, 1, 1], [1, 2, 3, 4])
    assert 0 <= low < 0.8 < high <= 1


def test_hashes(spark):
    assert len(one(spark, "x", lambda c: hashing.article_id("m", "1", c, c))) == 12
    a, b = (spark.createDataFrame([(v,)], "v array<string>").select(hashing.set_hash(F.col("v"))).first()[0] for v in (["a", "b"], ["b", "a", "a"]))
    assert a == b and len(a) == 16


def test_text_helpers(spark):
    assert one(spark, "<p>a &amp;&nbsp;b</p> <br> c", X.strip_html) == "a & b c"
    assert one(spark, "", X.script_of) == "empty" and one(spark, "東京", X.script_of) == "zh/ja-han" and one(spark, "мир", X.script_of) == "ru-cyrillic"
    assert one(spark, "abcdef", lambda c: X.truncate(c, 4)) == "abc…" and one(spark, "abcd", lambda c: X.truncate(c, 4)) == "abcd"
    assert one(spark, ["a", "b", "c"], X.bigrams, "array<string>") == ["a b", "b c"] and one(spark, ["a"], X.bigrams, "array<string>") == []
    sets = spark.createDataFrame([(["a", "b", "c"], ["b", "c", "d"]), ([], [])], "a array<string>, b array<string>")
    assert [r[0] for r in sets.select(X.jaccard(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0]
    assert [r[0] for r in sets.select(X.jaccard(F.col("a"), F.col("b"), "null")).collect()] == [0.5, None]
