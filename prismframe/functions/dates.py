"""Dates as feeds write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("dd MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss Z", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def parse_published(text: Column) -> Column:
    """The first format that fits, null if none does. GMT and UTC are +0000; without a zone it is UTC. Weekdays go unread."""
    text = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3,9},?\s+(?=\d)", "")
    text = F.regexp_replace(F.regexp_replace(text, r"\s*\b(?:GMT|UTC)$", " +0000"), r"(\dT[\d:.]+)Z$", "$1+00:00")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in FORMATS])


def age_hours(published: Column, now: Column) -> Column:
    """To one decimal; negative for clocks that run ahead."""
    return F.round((F.unix_timestamp(now) - F.unix_timestamp(published)) / 3600, 1)


def within_days(text: Column, days: int, now: Column) -> Column:
    """An empty or unreadable date passes."""
    return F.coalesce(parse_published(text) >= now - F.expr(f"INTERVAL {int(days)} DAYS"), F.lit(True))
