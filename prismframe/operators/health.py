"""Operational health: feeds that fail, stall or give stubs; what a pull brought; silence that is structural."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PAYWALL = r"(?i)(?:subscribers?|members?) only|(?:subscribe to|register to|sign in to) read|subscribe to continue|to continue reading|premium content|unlock this article|this article is for"


def feed_health(feeds: DataFrame, stub_pct: float = 80.0, slow_ms: int = 5000) -> DataFrame:
    """Adds ``stub_pct`` (1 place, null without items), ``stub_only``, ``slow`` and ``failed``.

    ``feeds``: n_items, n_stubs, http_status, error, fetch_ms. A feed failed with an error or a status other than 200; no
    status is no failure.
    """
    share = 100.0 * F.col("n_stubs") / F.nullif(F.col("n_items"), F.lit(0))
    failed = (F.coalesce(F.col("error"), F.lit("")) != "") | (F.coalesce(F.col("http_status"), F.lit(200)) != 200)
    return feeds.select("*", F.round(share, 1).alias("stub_pct"), F.coalesce(share >= stub_pct, F.lit(False)).alias("stub_only"), (F.coalesce(F.col("fetch_ms"), F.lit(0)) > slow_ms).alias("slow"), failed.alias("failed"))


def pull_report(feeds: DataFrame, slowest: int = 15) -> DataFrame:
    """(section, bucket, feed, value) of a day's pull: totals, items per bucket, errored and stub-only feeds, the slowest.

    Here a feed without a status counts as errored. ``feeds``: bucket, feed and the columns of ``feed_health``.
    """
    h = feed_health(feeds)
    errored = (F.coalesce(F.col("error"), F.lit("")) != "") | (F.coalesce(F.col("http_status"), F.lit(0)) != 200)
    totals = h.agg(F.count(F.lit(1)).alias("feeds"), F.sum("n_items").alias("items"), F.count_if(errored).alias("errored"), F.count_if("stub_only").alias("stub_only"))
    none = F.lit(None).cast("string")
    sections = [
        totals.unpivot([], ["feeds", "items", "errored", "stub_only"], "name", "value").select(F.lit("total").alias("section"), F.col("name").alias("bucket"), none.alias("feed"), F.col("value").cast("double").alias("value")),
        h.groupBy("bucket").agg(F.sum("n_items").cast("double").alias("value")).select(F.lit("items").alias("section"), "bucket", none.alias("feed"), "value"),
        h.filter(errored).select(F.lit("errored").alias("section"), "bucket", "feed", F.col("http_status").cast("double").alias("value")),
        h.filter("stub_only").select(F.lit("stub_only").alias("section"), "bucket", "feed", F.col("stub_pct").alias("value")),
        h.orderBy(F.desc("fetch_ms"), "bucket", "feed").limit(slowest).select(F.lit("slow").alias("section"), "bucket", "feed", F.col("fetch_ms").cast("double").alias("value")),
    ]
    out = sections[0]
    for s in sections[1:]:
        out = out.unionByName(s)
    return out


def structural_silence(alerts: DataFrame, least: float = 2.0) -> DataFrame:
    """Buckets whose volume dropped to nothing although they carried ``least`` items a day: (bucket, alert_type, now, avg7,
    drop_pct, reason). ``alerts``: bucket, alert_type, now, avg7, drop_pct and any others, which stay.
    """
    hit = (F.col("alert_type") == "volume_drop") & (F.col("now") == 0) & (F.col("avg7") >= least)
    reason = F.concat(F.lit("no items today, "), F.format_number("avg7", 1), F.lit(" a day before: the feeds failed or were empty, so read the absence as structural"))
    return alerts.filter(hit).withColumn("alert_type", F.lit("structural_silence")).withColumn("reason", reason)


def paywalled(summary: Column) -> Column:
    return F.coalesce(summary.rlike(PAYWALL), F.lit(False))


def repeats_title(title: Column, summary: Column, slack: int = 60) -> Column:
    """The summary is the title's start and hardly longer."""
    def plain(c: Column) -> Column:
        return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"&nbsp;|\s+", " "))

    t, s = plain(title), plain(summary)
    return s.startswith(F.left(t, F.lit(60))) & (F.length(s) - F.length(t) < slack)


def content_signals(items: DataFrame, by: list[str], title: str, summary: str, link: str) -> DataFrame:
    """Per feed the mean length of summaries and the percentages that hit a paywall, go through an aggregator or repeat the title."""
    def pct(c: Column) -> Column:
        return F.round(100.0 * F.count_if(c) / F.count(F.lit(1)), 4)

    s = F.coalesce(F.trim(F.col(summary)), F.lit(""))
    return items.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.length(s)), 4).alias("mean_chars"), pct(paywalled(s)).alias("paywall_pct"),
        pct(F.coalesce(F.col(link).contains("news.google.com"), F.lit(False))).alias("aggregator_pct"), pct(repeats_title(F.col(title), F.col(summary))).alias("title_pct"),
    )


def status_bucket(status: Column) -> Column:
    """The first of the known words that a declared status holds."""
    s = F.upper(F.coalesce(status, F.lit("UNKNOWN")))
    out = F.when(s.contains("CONFIRMED"), "CONFIRMED").when(s.contains("OK"), "OK").when(s.contains("LIKELY"), "LIKELY OK")
    return out.when(s.contains("EXPECTED FAIL"), "EXPECTED FAIL").when(s.contains("UNCERTAIN"), "UNCERTAIN").otherwise("OTHER")


def section_hint(path: Column, host: Column) -> Column:
    p, out = F.lower(path), None
    for word in ("world", "politics", "international"):
        out = F.when(p.contains(word), word) if out is None else out.when(p.contains(word), word)
    return out.when(host.contains("news.google.com"), "google_news_search").otherwise("root/other")


def first_per_key(rows: DataFrame, key: Column, order: list[Column], most: int) -> DataFrame:
    """The best row of each ``key``, and of those the ``most`` best, with ``rank`` from 1. ``order`` must be total."""
    one = rows.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(*order))).filter("_r = 1").drop("_r")
    return one.orderBy(*order).limit(most).withColumn("rank", F.row_number().over(W.partitionBy(F.lit(1)).orderBy(*order)).cast("long"))
