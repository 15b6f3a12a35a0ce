"""What to publish: card cascades, hero choice, drift gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Strength of a card kind in the choice of the day's hero.
STRENGTH = {"joint": 0.70, "shift": 0.60, "silence": 0.55, "word": 0.50, "tilt": 0.45, "sources": 0.40, "fallback": 0.20}


def cascade(rules: list[tuple[str, Column]], fallback: str = "fallback") -> Column:
    """The first kind whose condition holds; null conditions don't."""
    return F.coalesce(*[F.when(condition, F.lit(kind)) for kind, condition in rules], F.lit(fallback))


def standard_cascade() -> Column:
    """Over per-story signals: joint_len, max_delta_7d, n_silent, max_z, n_speakers, n_types, n_outlets, max_llr."""
    return cascade([
        ("joint", F.col("joint_len") >= 60), ("shift", F.abs("max_delta_7d") >= 0.20), ("silence", F.col("n_silent") >= 3), ("tilt", F.col("max_z") >= 4),
        ("sources", (F.col("n_speakers") >= 5) & (F.col("n_types") >= 3) & (F.col("n_outlets") >= 2)), ("word", F.col("max_llr") >= 20),
    ])


def hero(stories: DataFrame, recent: DataFrame, day: str, least: int = 8, total: int = 54, back: int = 5) -> DataFrame:
    """Per day the story with the best score: spread and strength, less 0.3 (kind) and 0.5 (key) if shown in ``back`` days."""
    strength = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in STRENGTH.items() for x in kv]), F.col("kind")), F.lit(0.0))
    seen = recent.select(F.col(day).alias("_d"), F.col("kind").alias("_k"), F.col("key").alias("_s"))
    near = (F.col("_d") < F.col(day)) & (F.col("_d") >= F.date_sub(F.col(day), back))
    shown = stories.filter(F.col("n_buckets") >= least).join(seen, near, "left").groupBy(*stories.columns).agg(F.coalesce(F.max(F.col("_k") == F.col("kind")), F.lit(False)).alias("k"), F.coalesce(F.max(F.col("_s") == F.col("key")), F.lit(False)).alias("s"))
    penalty = F.greatest(F.lit(0.0), 1 - F.when(F.col("k"), 0.3).otherwise(0.0) - F.when(F.col("s"), 0.5).otherwise(0.0))
    scored = shown.withColumn("score", F.round((F.col("n_buckets") / total * 0.30 + strength) * penalty, 6))
    return scored.withColumn("r", F.row_number().over(W.partitionBy(day).orderBy(F.desc("score"), "key"))).filter("r = 1").drop("r", "k", "s")


def hook(paradox: Column, isolation: Column, exclusive: Column) -> Column:
    """Why a thread opens: paradox, then isolation below 0.30, then exclusive words, else generic."""
    return cascade([("paradox", paradox), ("isolation", isolation < 0.30), ("exclusive", exclusive)], "generic")


def drift(today: DataFrame, baseline: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """Match rate and mean cosine of a canary against its baseline, with the gates 0.75 and 0.92."""
    from ..functions.vectors import cosine

    both = today.select(key, F.col(label).alias("l1"), F.col(vector).alias("v1")).join(baseline.select(key, F.col(label).alias("l0"), F.col(vector).alias("v0")), key)
    out = both.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("l1") == F.col("l0")).cast("double")).alias("match_rate"), F.avg(cosine("v1", "v0")).alias("mean_cosine"))
    return out.withColumn("drifted", (F.col("match_rate") < 0.75) | (F.col("mean_cosine") < 0.92))


def word_card(terms: DataFrame, most: int = 6) -> DataFrame:
    """The best term (``rank`` 1) of each bucket, the ``most`` distinctive ones by ``g2``."""
    return terms.filter("rank = 1").orderBy(F.desc("g2"), "bucket", "term").limit(most).select("bucket", "term", "g2")


def tilt_card(wire: DataFrame, mean: DataFrame, most: int = 5) -> DataFrame:
    """(bucket, z_wire, z_mean): the buckets that tilt most against the wire, with their tilt against the mean of others.

    Both: bucket, z. The greatest positive z of a bucket counts, 0 without one.
    """
    def top(t: DataFrame, name: str) -> DataFrame:
        return t.groupBy("bucket").agg(F.greatest(F.max("z"), F.lit(0.0)).alias(name))

    both = top(wire, "z_wire").join(top(mean, "z_mean"), "bucket", "full").na.fill(0.0)
    return both.orderBy(F.desc("z_wire"), "bucket").limit(most)


def shift_card(shares: DataFrame, frame: str, day: str, share: str, last: int = 7) -> DataFrame:
    """The entries of the last ``last`` days of the frame that moved most in them: (frame, day, share, delta)."""
    from .series import share_changes

    recent = share_changes(shares, [frame], day, share).withColumn("_r", F.row_number().over(W.partitionBy(frame).orderBy(F.desc(day)))).filter(F.col("_r") <= last)
    best = recent.groupBy(frame).agg(F.max(F.abs("delta")).alias("_m")).filter("_m > 0").orderBy(F.desc("_m"), frame).limit(1)
    return recent.join(best, frame, "left_semi").select(frame, day, share, "delta")
