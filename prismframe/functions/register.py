"""Functions by name, for SQL: ``register(spark)`` once a session."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources import feeds
from . import stats

_QUOTES = "array<struct<quote string, speaker string, verb string>>"


class ParseFeed:
    """``SELECT * FROM parse_feed(body)``: a row per item, with its position."""

    def eval(self, body):
        for i, item in enumerate(feeds.parse_feed_bytes(body)):
            yield i, item["title"], item["link"], item["summary"], item["published"]


def _erfc(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if v is None or v != v else math.erfc(v))


def _t_tail(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p of Student's t."""
    return pd.Series([None if a != a or b != b or b <= 0 else stats.incomplete_beta(b / 2, 0.5, b / (b + a * a)) for a, b in zip(t, df, strict=True)])


def _quotes(text: pd.Series) -> pd.Series:
    return text.map(feeds.quotes_in)


def register(spark: SparkSession) -> None:
    """``erfc``, ``t_tail``, ``quotes`` and the table function ``parse_feed``. What Spark expresses needs no name here."""
    spark.udf.register("erfc", F.pandas_udf(_erfc, "double"))
    spark.udf.register("t_tail", F.pandas_udf(_t_tail, "double"))
    spark.udf.register("quotes", F.pandas_udf(_quotes, _QUOTES))
    spark.udtf.register("parse_feed", F.udtf(ParseFeed, returnType="item_pos int, title string, link string, summary string, published string"))
