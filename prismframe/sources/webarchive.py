"""Archived copies: which crawl covers a date, index lines, records cut out of archive files."""

from __future__ import annotations

import gzip
import json
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def crawl_for(pages: DataFrame, day: str, crawls: DataFrame) -> DataFrame:
    """The crawl that covers a page's day, else the latest before it. ``crawls``: crawl, from_day, to_day.

    Days are joined to crawls by range and cut to the latest; crawls are few, days are distinct first.
    """
    days = pages.select(F.col(day).alias("_d")).distinct().join(crawls, F.col("from_day") <= F.col("_d"))
    best = days.withColumn("r", F.row_number().over(W.partitionBy("_d").orderBy(F.desc("from_day"), "crawl"))).filter("r = 1").select("_d", "crawl")
    return pages.join(best, F.col(day) == F.col("_d"), "left").drop("_d")


def first_capture(lines: Column) -> Column:
    """The first index line with status 200, as struct(filename, offset, length); null if there is none."""
    kind = "struct<url:string,status:string,filename:string,offset:string,length:string>"
    rows = F.transform(F.split(lines, "\n"), lambda x: F.from_json(x, kind))
    hit = F.try_element_at(F.filter(rows, lambda r: (r["status"] == "200") & r["filename"].isNotNull()), F.lit(1))
    return F.when(hit.isNotNull(), F.struct(hit["filename"].alias("filename"), hit["offset"].cast("long").alias("offset"), hit["length"].cast("long").alias("length")))


def byte_range(capture: Column) -> Column:
    return F.concat(F.lit("bytes="), capture["offset"].cast("string"), F.lit("-"), (capture["offset"] + capture["length"] - 1).cast("string"))


def record_html(raw: bytes | None) -> dict:
    """status (ok, no_record, bad_record, not_html) and text of a gzipped archive record."""
    if not raw:
        return {"status": "no_record", "html": None}
    try:
        plain = gzip.decompress(bytes(raw))
    except (OSError, EOFError, zlib.error):
        return {"status": "bad_record", "html": None}
    parts = plain.split(b"\r\n\r\n", 2)
    if len(parts) < 3:
        return {"status": "bad_record", "html": None}
    head = parts[1].decode("latin-1").lower()
    if "text/html" not in head and "xhtml" not in head:
        return {"status": "not_html", "html": None}
    charset = head.partition("charset=")[2].split("\r")[0].split(";")[0].strip().strip('"') or "utf-8"
    try:
        return {"status": "ok", "html": parts[2].decode(charset, "replace")}
    except LookupError:
        return {"status": "ok", "html": parts[2].decode("utf-8", "replace")}


def parse_record(raw: Column | str) -> Column:
    def over(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([record_html(x) for x in batch], columns=["status", "html"])

    return F.pandas_udf(over, "struct<status string, html string>")(raw)


def index_lines(rows: DataFrame, url: str, *columns: str) -> Column:
    """JSON index lines of a table, the inverse of ``first_capture`` for one row."""
    return F.to_json(F.struct(F.col(url).alias("url"), *columns))


def dumps(rows: list[dict]) -> str:
    return "\n".join(json.dumps(r) for r in rows)
