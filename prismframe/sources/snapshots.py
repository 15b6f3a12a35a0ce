"""Daily artefacts: dated history with corrupt files, nested source lists, sinks by date and by key, dimensions from text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .feeds import dated_files


def read_history(spark: SparkSession, path: str, schema: T.StructType, today: Column, days: int = 30, key: bool = True) -> DataFrame:
    """JSON artefacts named by date within the last ``days``; corrupt ones are skipped, not fatal."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    raw = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option("multiLine", "true").json(path)
    dated = dated_files(raw).filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    kept = dated.filter((F.col("file_date") <= today) & (F.col("file_date") > F.date_sub(today, days)))
    return kept if key else kept.drop("file_key")


def flatten_sources(sources: DataFrame, key: str = "story_key") -> DataFrame:
    """One row per attributed quote of nested ``sources`` arrays."""
    return sources.select(key, "date", F.posexplode("sources").alias("pos", "s")).select(key, "date", "pos", "s.*")


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """Words of a text file: ``#`` starts a comment, white space separates, lower case, distinct."""
    return spark.read.text(path).select(F.explode(F.split(F.trim(F.regexp_replace(F.lower("value"), "#.*$", "")), r"\s+")).alias("word")).filter("word <> ''").distinct()


def with_defaults(articles: DataFrame, outlets: DataFrame, on: str = "outlet", defaults: dict[str, str] | None = None) -> DataFrame:
    """Articles with their outlet's columns; what is unknown takes the article's own value, then the default.

    The dimension joins by Catalyst's choice from its size: no hint, so it may grow.
    """
    defaults = defaults or {"lang": "en", "section": "news"}
    dims = outlets.select(on, *[F.col(c).alias(f"_{c}") for c in outlets.columns if c != on])
    out = articles.join(dims, on, "left")
    for c in (x for x in outlets.columns if x != on):
        own = [F.col(c)] if c in articles.columns else []
        fallback = [F.lit(defaults[c])] if c in defaults else []
        out = out.withColumn(c, F.coalesce(F.col(f"_{c}"), *own, *fallback)).drop(f"_{c}")
    return out


def write_daily(df: DataFrame, path: str, day: str = "date") -> None:
    """Parquet by date; a rerun of a day replaces that day only."""
    df.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def write_json_tree(df: DataFrame, path: str, by: list[str]) -> None:
    """One JSON file per key under ``path``, for publication."""
    df.repartition(*by).write.mode("overwrite").partitionBy(*by).json(path)


def index(df: DataFrame, day: str, key: str, title: str) -> DataFrame:
    """Per day the stories in order and whether it is the latest: what a published index lists."""
    days = df.groupBy(day).agg(F.count(F.lit(1)).alias("n_stories"), F.transform(F.slice(F.array_sort(F.collect_list(F.struct(key, title))), 1, 3), lambda x: x[title]).alias("first_titles"))
    return days.crossJoin(df.agg(F.max(day).alias("_last"))).withColumn("latest", F.col(day) == F.col("_last")).drop("_last")


def aligned_embeddings(ids: DataFrame, vectors: DataFrame, by: str = "date") -> DataFrame:
    """Vectors joined to ids by row position; a day whose two lists differ in length gives nothing."""
    a = ids.select(by, F.posexplode("article_ids").alias("pos", "article_id"), F.size("article_ids").alias("_n"))
    b = vectors.select(by, F.posexplode("matrix").alias("pos", "embedding"), F.size("matrix").alias("_m"))
    return a.join(b, [by, "pos"]).filter("_n = _m").select(by, "article_id", "embedding")
