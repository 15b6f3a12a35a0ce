"""Term statistics across buckets: distinctive terms, log odds, tilt against baselines, exclusive vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import stats
from ..plans.session import shared_checkpoint


def counts(docs: DataFrame, by: list[str], words: Column, together: list[str] | None = None) -> DataFrame:
    """``by``, ``term``, ``n``: one partial aggregation and one shuffle. Terms that hardly repeat go to the place of the keys
    ``together`` as they are, and what is asked by these keys later needs no shuffle of its own.
    """
    rows = docs.select(*by, F.explode(words).alias("term"))
    return count_rows(rows.repartition(*together) if together else rows, by)


def count_rows(rows: DataFrame, by: list[str]) -> DataFrame:
    """``by``, ``term``, ``n`` of a row per occurrence."""
    return rows.groupBy(*by, "term").agg(F.count(F.lit(1)).alias("n"))


def against_cohort(found: DataFrame, bucket: str = "bucket", cohort: str = "lang", least: int = 1) -> DataFrame:
    """Counts with the cohort's others left over: ``a``, ``b``, ``total_a``, ``total_b``. What is left of the cohort without
    oneself is its sum minus one's own.

    The counts are written once, with the others': texts are split once, whatever is asked of them. Only (cohort, term)
    shuffles; totals are a row per bucket, aggregated map-side and joined by whatever their size allows. Of terms that a
    bucket has fewer than ``least`` times only their sum is written, for the totals.
    """
    others = F.sum("n").over(W.partitionBy(cohort, "term")) - F.col("n")
    found = found.select(bucket, cohort, "term", "n", others.alias("b"))
    if least > 1:
        often = F.col("n") >= least
        found = found.groupBy(bucket, cohort, F.when(often, F.col("term")).alias("term"), F.when(often, F.col("b")).alias("b")).agg(F.sum("n").alias("n"))
    found = shared_checkpoint(found)
    own = found.groupBy(bucket, cohort).agg(F.sum("n").alias("total_a"))
    totals = shared_checkpoint(own.join(own.groupBy(cohort).agg(F.sum("total_a").alias("all")), cohort))
    both = found.filter(F.col("term").isNotNull()).join(totals, [bucket, cohort])
    return both.select(bucket, cohort, "term", F.col("n").alias("a"), "b", "total_a", F.greatest(F.col("all") - F.col("total_a"), F.lit(1)).alias("total_b"))


def union_counts(*counters: DataFrame) -> DataFrame:
    """The sum of counters (same keys, ``n``): an item counts in all of them together."""
    keys = [c for c in counters[0].columns if c != "n"]
    out = counters[0]
    for more in counters[1:]:
        out = out.unionByName(more)
    return out.groupBy(*keys).agg(F.sum("n").alias("n"))


def subtract_counts(of: DataFrame, less: DataFrame) -> DataFrame:
    """``of`` minus ``less`` (same keys, ``n``): items that nothing is left of are gone."""
    return union_counts(of, less.withColumn("n", -F.col("n"))).filter("n > 0")


def log_likelihood(table: DataFrame, by: list[str], least: int = 5, top: int = 20) -> DataFrame:
    """The ``top`` over-represented terms per ``by`` with G2 above the 0.001 threshold. Ties go to the earlier term."""
    a, b, ta, tb = (F.col(c) for c in ("a", "b", "total_a", "total_b"))
    g2 = F.round(stats.g2(a, b, ta, tb), 6)
    kept = table.filter((a >= least) & (a * tb > b * ta)).withColumn("g2", g2).filter(F.col("g2") >= stats.CHI2_001)
    ratio = F.when(b > 0, F.round(F.log2((a / ta) / (b / tb)), 6))
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("g2"), "term"))
    return kept.withColumn("log_ratio", ratio).withColumn("rank", rank).filter(F.col("rank") <= top)


def log_odds_terms(table: DataFrame, by: list[str], least: int = 2, top: int = 25) -> DataFrame:
    """The ``top`` terms per ``by`` by z of the log odds ratio, z at least 1.96."""
    delta, z = stats.log_odds(F.col("a"), F.col("b"), F.col("total_a"), F.col("total_b"))
    kept = table.filter(F.col("a") >= least).withColumn("log_odds", F.round(delta, 6)).withColumn("z", F.round(z, 6)).filter(F.col("z") >= F.lit(1.96))
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("z"), "term"))
    return kept.withColumn("rank", rank).filter(F.col("rank") <= top)


def exclusive(found: DataFrame, bucket: str = "bucket", least: int = 3) -> DataFrame:
    """Terms that only one bucket uses, ``least`` times or more."""
    return found.withColumn("df", F.count(F.lit(1)).over(W.partitionBy("term"))).filter((F.col("df") <= 1) & (F.col("n") >= least)).select(bucket, "term", "n")


def persistent_baseline(docs: DataFrame, day: str, words: Column, least_days: int = 14, least: int = 2) -> DataFrame:
    """Terms of a wire's articles seen at least ``least`` times, once it has published on ``least_days`` days; else nothing."""
    long = docs.select(F.col(day).alias("day"), F.explode(words).alias("term"))
    days = docs.select(F.col(day).alias("day")).agg(F.count_distinct("day").alias("days"))
    return long.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).crossJoin(days).filter(F.col("days") >= least_days).select("term", "n")


def tilt(own: DataFrame, baseline: DataFrame, by: str, least: int = 2) -> DataFrame:
    """Log odds of every term of an outlet, or of the baseline, against the baseline: ``a``, ``b``, ``log_odds``, ``z``.

    Terms seen fewer than ``least`` times on both sides are left out. ``own`` is read three times: pass it written.
    """
    totals = shared_checkpoint(own.groupBy(by).agg(F.sum("n").alias("total_a")))
    base = shared_checkpoint(baseline.select("term", F.col("n").alias("b")))
    common = base.filter(F.col("b") >= least)
    here = own.select(by, "term", F.col("n").alias("a")).join(base, "term", "left").na.fill(0, ["b"]).filter((F.col("a") >= least) | (F.col("b") >= least))
    absent = totals.select(by).crossJoin(common).join(own.join(common.select("term"), "term", "left_semi").select(by, "term"), [by, "term"], "left_anti")
    keys = here.select(by, "term", "a", "b").unionByName(absent.select(by, "term", F.lit(0).cast("long").alias("a"), "b"))
    joined = keys.join(totals, by).crossJoin(base.agg(F.sum("b").alias("total_b")))
    delta, z = stats.log_odds(F.col("a"), F.col("b"), F.col("total_a"), F.col("total_b"))
    return joined.withColumn("log_odds", F.round(delta, 6)).withColumn("z", F.round(z, 6))


def _with(tests: DataFrame, one: DataFrame, family: list[str]) -> DataFrame:
    """``tests`` with the columns of their family's row in ``one``."""
    if not family:
        return tests.crossJoin(one)
    return _matched(tests, one, family, "left")


def _matched(rows: DataFrame, one: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``rows`` joined to ``one`` on ``keys``, where null equals null."""
    renamed = one.select(*[F.col(k).alias(f"{k}__") for k in keys], *[c for c in one.columns if c not in keys])
    same = None
    for k in keys:
        equal = F.col(k).eqNullSafe(F.col(f"{k}__"))
        same = equal if same is None else same & equal
    return rows.join(renamed, same, how).drop(*[f"{k}__" for k in keys])


def benjamini_hochberg(tests: DataFrame, p: str, family: list[str], q: float = 0.05) -> DataFrame:
    """Adds ``significant``: p at most the largest p(k) with p(k) <= k / n * q. Equal p share the verdict; null p never is.

    No family is sorted in one task: equal p are counted first, values of p fall into slices (halves near 0, thousandths
    above), slice totals are summed up in order, and only values within a slice are ranked.
    """
    value = F.col("_p")
    fine = F.lit(1074) + F.floor(value * 1000)
    slice_ = F.when(value >= 0.001, fine).when(value > 0, F.lit(1073) - F.least(F.lit(1073), F.floor(-F.log2(value)))).otherwise(-1)
    keyed = tests.filter(F.col(p).isNotNull()).groupBy(*family, F.col(p).cast("double").alias("_p")).agg(F.count(F.lit(1)).alias("_c")).withColumn("_s", slice_.cast("int"))
    slices = keyed.groupBy(*family, "_s").agg(F.sum("_c").alias("_here"))
    order = W.partitionBy(*family) if family else W.partitionBy(F.lit(1))  # at most 2,077 slices a family
    placed = slices.withColumn("_before", F.sum("_here").over(order.orderBy("_s")) - F.col("_here")).withColumn("_n", F.sum("_here").over(order)).drop("_here")
    ranked = keyed.withColumn("_k", F.sum("_c").over(W.partitionBy(*family, "_s").orderBy("_p")))
    whole = _matched(ranked, placed, [*family, "_s"], "inner")
    limit = whole.filter(F.col("_p") <= (F.col("_before") + F.col("_k")) / F.col("_n") * q).groupBy(*family).agg(F.max("_p").alias("_limit"))
    return _with(tests, limit, family).withColumn("significant", F.coalesce(F.col(p) <= F.col("_limit"), F.lit(False))).drop("_limit")


def bonferroni(tests: DataFrame, p: str, family: list[str], alpha: float = 0.05) -> DataFrame:
    sizes = tests.groupBy(*family).agg(F.count(F.lit(1)).alias("_n"))
    return _with(tests, sizes, family).withColumn("significant", F.col(p) <= F.lit(alpha) / F.col("_n")).drop("_n")
