"""Coverage: which bucket carried which story, and how healthy the feeds were."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_matches(items: DataFrame, feed: str, pos: str, hit: str, fields: list[str]) -> DataFrame:
    """Per feed: ``n_matching`` and the first matching item's rank (from 1) and fields. No sort: a minimum by position."""
    first = F.min(F.when(F.col(hit), F.struct(F.col(pos), *[F.col(f) for f in fields])))
    out = items.groupBy(feed).agg(F.count_if(F.col(hit)).alias("n_matching"), first.alias("_f"))
    return out.select(feed, "n_matching", (F.col(f"_f.{pos}") + 1).cast("long").alias("first_match_rank"), *[F.col(f"_f.{f}").alias(f"first_match_{f}") for f in fields])


def matrix(stories: DataFrame, buckets: DataFrame, matched: DataFrame, observed: DataFrame) -> DataFrame:
    """(story, bucket, state): covered if matched; else errored if its feeds failed; silent if it was observed; else dark.

    ``matched``: story, bucket; ``observed``: bucket, ``failed`` (every feed failed).
    """
    grid = stories.select("story").distinct().crossJoin(buckets.select("bucket").distinct())
    hits = matched.select("story", "bucket").distinct().withColumn("_m", F.lit(True))
    state = F.when(F.col("_m"), "covered").when(F.col("failed"), "errored").when(F.col("failed").isNotNull(), "silent").otherwise("dark")
    return grid.join(hits, ["story", "bucket"], "left").join(observed.select("bucket", "failed"), "bucket", "left").select("story", "bucket", state.alias("state"))


def upper_median(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """The upper of the two middle values, as a list index gives it; null without values."""
    ordered = F.array_sort(F.collect_list(value))
    g = rows.groupBy(*by) if by else rows.groupBy()
    return g.agg(ordered.alias("_v")).select(*by, F.try_element_at("_v", F.floor(F.size("_v") / 2).cast("int") + 1).alias("upper_median"))


def status_table(items: DataFrame, bucket: str, status: str) -> DataFrame:
    """Counts per extraction status, and FULL as a percentage of all that was attempted; a total row has bucket null."""
    names = ("FULL", "PARTIAL", "STUB", "NONE", "ERROR", "SKIPPED")
    counts = [F.count_if(F.col(status) == s).alias(s.lower()) for s in names]
    out = items.rollup(bucket).agg(*counts, F.count(F.lit(1)).alias("total"))
    tried = F.col("total") - F.col("skipped")
    return out.withColumn("full_pct", F.when(tried > 0, F.round(100.0 * F.col("full") / tried, 4)))


def weighted_share(carriers: DataFrame, weights: DataFrame) -> DataFrame:
    """Per frame: share of all buckets' weight, and of their number. ``carriers``: frame, bucket; ``weights``: bucket, weight.

    A bucket without weight weighs 1. Repeats of (frame, bucket) count once; the whole is every bucket of any frame.
    """
    each = carriers.select("frame", "bucket").distinct().join(weights.select("bucket", "weight"), "bucket", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    whole = each.select("bucket", "weight").distinct().agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n"))
    return each.groupBy("frame").agg(F.sum("weight").alias("fw"), F.count(F.lit(1)).alias("fn")).crossJoin(whole).select("frame", (F.col("fw") / F.col("w")).alias("weighted_share"), (F.col("fn") / F.col("n")).alias("share"))


def bootstrap_shares(carriers: DataFrame, weights: DataFrame, draws: int = 1000, seed: int = 42) -> DataFrame:
    """Adds a 90 % interval to the weighted share of each frame, resampling buckets (few, so a frame is one task's work)."""
    from ..functions.stats import bootstrap_interval

    each = carriers.select("frame", "bucket").distinct().join(weights.select("bucket", "weight"), "bucket", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    buckets = each.select("bucket", "weight").distinct()
    grid = each.select("frame").distinct().crossJoin(buckets).join(each.select("frame", "bucket", F.lit(1.0).alias("x")), ["frame", "bucket"], "left").na.fill(0.0, ["x"])

    def interval(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values("bucket")
        low, high = bootstrap_interval(pdf["x"].tolist(), pdf["weight"].tolist(), draws, seed)
        return pd.DataFrame({"frame": [key[0]], "low": [low], "high": [high]})

    return grid.groupBy("frame").applyInPandas(interval, "frame string, low double, high double")
