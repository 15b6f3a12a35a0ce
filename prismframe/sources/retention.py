"""Retention: what is older than the window moves to an archive by category and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expired(rows: DataFrame, day: str, today: Column, window: int = 90) -> DataFrame:
    """Strictly older than ``today - window``."""
    return rows.filter(F.col(day) < F.date_sub(today, window))


def manifest(rows: DataFrame, day: str, by: list[str], name: str, today: Column, window: int = 90) -> DataFrame:
    """Per month and category: number, first and last name of what expires."""
    old = expired(rows, day, today, window)
    return old.groupBy(F.trunc(day, "month").alias("month"), *by).agg(F.count(F.lit(1)).alias("n_files"), F.min(name).alias("first_name"), F.max(name).alias("last_name"))


def archive(rows: DataFrame, day: str, category: str, today: Column, path: str, window: int = 90) -> None:
    """Write what expires to ``path`` as Parquet by category and month. Repeating it appends nothing twice if the path is fresh."""
    expired(rows, day, today, window).withColumn("month", F.date_format(day, "yyyy-MM")).repartition(category, "month").write.partitionBy(category, "month").option("compression", "zstd").parquet(path)
