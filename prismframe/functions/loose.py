"""What language models and pages write loosely: JSON in fences or prose, quotes with other spacing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def loose_json(text: Column) -> Column:
    """A variant of the text's JSON: all of it without a code fence, else from the first brace to the last; null if neither parses."""
    s = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", ""))
    opened = F.regexp_replace(s, r"^```[^\n]*\n", "")
    bare = F.when(s.startswith("```"), F.regexp_replace(F.regexp_replace(opened, r"^```", ""), r"\s*```$", "")).otherwise(s)
    inner = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    return F.coalesce(F.try_parse_json(F.nullif(bare, F.lit(""))), F.try_parse_json(F.nullif(inner, F.lit(""))))


def spaced(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def quote_found(quote: Column, original: Column) -> Column:
    """The original holds the quote, whatever the spacing, or whatever the case where spacing agrees."""
    return spaced(original).contains(spaced(quote)) | F.lower(F.coalesce(original, F.lit(""))).contains(F.lower(F.coalesce(quote, F.lit(""))))
