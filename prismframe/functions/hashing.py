"""Identifiers derived from content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def item_id(title: Column, link: Column) -> Column:
    return F.left(F.md5(F.concat(F.coalesce(title, F.lit("")), F.coalesce(link, F.lit("")))), F.lit(8))


def article_id(model: Column | str, version: Column | str, feed: Column, link: Column) -> Column:
    model, version = (F.lit(x) if isinstance(x, str) else x for x in (model, version))
    return F.left(F.sha2(F.concat_ws("|", model, version, feed, link), 256), F.lit(12))


def lineage_id(date: Column, cluster: Column) -> Column:
    return F.concat(F.lit("L"), F.left(F.sha2(F.concat_ws("|", date.cast("string"), cluster.cast("string")), 256), F.lit(10)))


def set_hash(values: Column, sep: str = ",", n: int = 16) -> Column:
    """Of a set of strings, whatever their order."""
    return F.left(F.sha2(F.array_join(F.array_sort(F.array_distinct(values)), sep), 256), F.lit(n))


def model_prefix(model: Column) -> Column:
    return F.when(F.lower(model).contains("e5"), "passage: ").otherwise("")
