"""Series over days: trailing means, run lengths, lagged correlation, trajectories, stability, rot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import jaccard


def day_number(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date"))


def trailing_mean(daily: DataFrame, by: list[str], day: str, value: str, days: int = 7) -> DataFrame:
    """Adds ``trailing_mean`` over the previous ``days`` calendar days that exist, today left out."""
    w = W.partitionBy(*by).orderBy(day_number(F.col(day))).rangeBetween(-days, -1)
    return daily.withColumn("trailing_mean", F.avg(value).over(w))


def volume_drops(daily: DataFrame, by: list[str], day: str, value: str, least: float = 5) -> DataFrame:
    """Days below half of a trailing mean that is at least ``least``, with ``drop_pct``."""
    t = trailing_mean(daily, by, day, value)
    return t.filter((F.col("trailing_mean") >= least) & (F.col(value) * 2 < F.col("trailing_mean"))).withColumn("drop_pct", F.round(100 * (1 - F.col(value) / F.col("trailing_mean")), 4))


def runs(rows: DataFrame, by: list[str], day: str, value: str) -> DataFrame:
    """Runs of equal ``value``: (by, value, from_day, to_day, n_days), gaps and islands with one window order."""
    w = W.partitionBy(*by).orderBy(day)
    changed = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & F.lag(F.lit(1)).over(w).isNotNull(), 0).otherwise(1)
    marked = rows.withColumn("_c", changed).withColumn("_g", F.sum("_c").over(w))
    return marked.groupBy(*by, "_g").agg(F.first(value).alias(value), F.min(day).alias("from_day"), F.max(day).alias("to_day"), F.count(F.lit(1)).alias("n_days")).drop("_g")


def share_changes(shares: DataFrame, by: list[str], day: str, share: str, least: float = 0.1) -> DataFrame:
    """Adds ``delta`` to the previous entry (however old) and ``moved`` when it exceeds ``least``."""
    delta = F.col(share) - F.lag(share).over(W.partitionBy(*by).orderBy(day))
    return shares.withColumn("delta", delta).withColumn("moved", F.coalesce(F.abs("delta") > least, F.lit(False)))


def largest_recent_move(shares: DataFrame, by: list[str], day: str, share: str, last: int = 7) -> DataFrame:
    """Largest |delta| among the last ``last`` entries of each series."""
    changes = share_changes(shares, by, day, share).withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy(F.desc(day))))
    return changes.filter(F.col("_r") <= last).groupBy(*by).agg(F.max(F.abs("delta")).alias("max_move"))


def lagged_correlation(presence: DataFrame, pairs: DataFrame, days: DataFrame, max_lag: int = 7) -> DataFrame:
    """Pearson r of a[pos] with b[pos + lag] for lags -max_lag..max_lag: (a, b, story, lag, n, r).

    ``presence``: bucket, story, day, 0/1 ``x`` where present (absent days are 0); ``pairs``: a, b; ``days``: the
    available days, whose positions are shifted. A series without any presence is skipped. r is null with fewer than 3
    pairs or without variance. Only the present days are joined; zeros enter through counts, so no day x bucket x story
    spine is built.
    """
    position = days.select("day", (F.row_number().over(W.partitionBy(F.lit(1)).orderBy("day")) - 1).alias("pos"))
    size = days.agg(F.count(F.lit(1)).alias("d"))
    at = presence.filter("x <> 0").join(position, "day").select("bucket", "story", "pos")
    lags = F.explode(F.sequence(F.lit(-max_lag), F.lit(max_lag)))
    series = at.groupBy("bucket", "story").agg(F.array_sort(F.collect_set("pos")).alias("p"))
    met = pairs.join(series.select(F.col("bucket").alias("a"), "story", F.col("p").alias("pa")), "a").join(series.select(F.col("bucket").alias("b"), "story", F.col("p").alias("pb")), ["b", "story"])
    each = met.select("a", "b", "story", "pa", "pb", lags.alias("lag")).crossJoin(size)
    low, high = F.greatest(F.lit(0), -F.col("lag")), F.least(F.col("d"), F.col("d") - F.col("lag"))
    n = F.greatest(high - low, F.lit(0)).cast("long")
    inside_a = F.filter("pa", lambda p: (p >= low) & (p < high))
    shifted_b = F.filter(F.transform("pb", lambda p: p - F.col("lag")), lambda p: (p >= low) & (p < high))
    sums = each.select("a", "b", "story", "lag", n.alias("n"), F.size(inside_a).alias("sa"), F.size(shifted_b).alias("sb"), F.size(F.array_intersect(inside_a, shifted_b)).alias("sab"))
    va, vb = F.col("n") * F.col("sa") - F.col("sa") * F.col("sa"), F.col("n") * F.col("sb") - F.col("sb") * F.col("sb")
    r = F.when((F.col("n") >= 3) & (va > 0) & (vb > 0), (F.col("n") * F.col("sab") - F.col("sa") * F.col("sb")) / F.sqrt(va.cast("double") * vb))
    return sums.select("a", "b", "story", "lag", "n", r.alias("r"))


def peak_lag(ccf: DataFrame) -> DataFrame:
    """The lag of the largest r per pair and story; ties go to the smallest lag."""
    best = F.row_number().over(W.partitionBy("a", "b", "story").orderBy(F.desc("r"), "lag"))
    return ccf.filter("r IS NOT NULL").withColumn("_r", best).filter("_r = 1").drop("_r")


def set_stability(sets: DataFrame, by: list[str], day: str, values: str, least: float = 0.5) -> DataFrame:
    """Mean Jaccard of the sets of consecutive available days, and ``unstable`` below ``least``. Two empty sets give no pair."""
    before = F.lag(values).over(W.partitionBy(*by).orderBy(day))
    pairs = sets.withColumn("_b", before).filter("_b IS NOT NULL").withColumn("_j", jaccard(F.col("_b"), F.col(values), "null"))
    return pairs.groupBy(*by).agg(F.avg("_j").alias("stability"), F.count("_j").alias("n_pairs")).withColumn("unstable", F.col("stability") < least)


def feed_rot(daily: DataFrame, feed: str, day: str, bad: str, value: str, bad_days: int = 4) -> DataFrame:
    """(feed, n_bad, first, last, n_days, rotten, declining): bad on ``bad_days`` days; or a fall from 5 to below half."""
    g = daily.groupBy(feed).agg(F.count_if(F.col(bad)).alias("n_bad"), F.min_by(value, day).alias("first"), F.max_by(value, day).alias("last"), F.count(F.lit(1)).alias("n_days"))
    return g.withColumn("rotten", F.col("n_bad") >= bad_days).withColumn("declining", (F.col("n_days") >= 4) & (F.col("first") >= 5) & (F.col("last") * 2 < F.col("first")))


def steepest_declines(rot: DataFrame, feed: str, most: int = 20) -> DataFrame:
    """Of ``feed_rot`` the declining feeds, those that gave most at first before the others."""
    return rot.filter("declining").orderBy(F.desc("first"), feed).limit(most).select(feed, "first", "last")
