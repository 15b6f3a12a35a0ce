"""Helpers shared by the corpus operators: reading tables, cutting lineage, clash-free column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import drop_checkpoint as drop_cut
from ..plans.session import shared_checkpoint as cut

__all__ = ["col", "cut", "drop_cut", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")
