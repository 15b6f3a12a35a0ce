"""Site-relative line dedup: a line that too large a share of a site's pages carry is boilerplate.

Lines are counted once per page, grouped by host, and divided by the host's page total. Only two 64-bit hashes of a
line travel, never its text: counts combine map-side, the few boilerplate lines meet the pages' line hashes again, and
each page then drops its own marked lines by number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, cut, table

#: Regular expressions, the same in Java and RE2, that turn HTML into lines: what holds no text, the ends of blocks, other tags.
NO_TEXT = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
BLOCK = r"(?i)</?(?:p|li|ul|ol|div|nav|article|section|header|footer|aside|h[1-6]|br|tr|td|th|table|title|head|body|html|blockquote|pre|form)(?:[ /][^>]*)?>"
TAG = r"<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
STEPS = ((NO_TEXT, " "), (BLOCK, "\n"), (TAG, ""), (r"[ \t\r\f]+", " "), (r" ?\n[ \n]*", "\n"))


def html_lines(html: Column) -> Column:
    """Visible lines of a page: tags gone, spaces collapsed, ends trimmed, no empty lines."""
    text = html
    for pattern, by in STEPS:
        text = F.regexp_replace(text, pattern, by)
    return F.filter(F.split(F.trim(text), "\n"), lambda x: x != "")


def host_of(url: Column) -> Column:
    """Lower-case host without port; null when the URL has none."""
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", host)


def drop_boilerplate_lines(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    max_ratio: float = 0.3, min_pages: int = 3, lines: Column | None = None, host: Column | None = None,
) -> DataFrame:
    """Per page: id, ``host``, ``text`` (kept lines joined by newline), ``n_lines``, ``n_dropped``.

    A line is dropped from every page of a host if at least ``min_pages`` pages of that host carry it and they are more
    than ``max_ratio`` of the host's pages. Repeats inside one page count once. Rows are pages: repeated rows count as
    pages of their own and all come back. A URL without host (or null) forms the group of its own "" host. Null HTML is
    an empty page, which counts in the host's total. Ids may be null or repeated. An empty table gives an empty one; very
    long pages are used whole. A share of exactly ``max_ratio`` stays. Other columns are not read, so no names clash.
    """
    lines = html_lines(col(html_col)) if lines is None else lines
    host = host_of(col(url_col)) if host is None else host
    read = cut(pages.select(col(id_col).alias("id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(lines, F.array().cast("array<string>")).alias("lines")))

    def mark(x: Column) -> Column:
        return F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit("salt"), x).alias("b"))

    seen = read.select("host", F.explode(F.array_distinct(F.transform("lines", mark))).alias("k"))
    counts = seen.groupBy("host", "k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    totals = read.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    # a host has at most (lines a page) / max_ratio such lines; written, the table has a known size, by which Catalyst picks the join
    boilerplate = cut(counts.join(totals, "host").filter(F.col("n") > F.lit(max_ratio) * F.col("pages")).groupBy("host").agg(F.collect_list("k").alias("dropped")))
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains("dropped", mark(x))))
    return (
        read.join(boilerplate, "host", "left")
        .select("id", "host", kept.alias("kept"), F.size("lines").cast("long").alias("n_lines"))
        .select(F.col("id").alias(id_col), "host", F.array_join("kept", "\n").alias("text"), "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate_lines(table(spark, sf_dir, "pages"))


def _sql() -> str:
    text = "html"
    for pattern, by in STEPS:
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')".replace("\n', 'g')", "' || chr(10), 'g')") if by == "\n" else f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    return f"""
WITH pages_lines AS (
  SELECT row_number() OVER () AS r, page_id,
         coalesce(nullif(lower(regexp_extract(url, '{HOST}', 1)), ''), '') AS host,
         coalesce(list_filter(string_split(trim({text}), chr(10)), lambda x: x <> ''), CAST([] AS VARCHAR[])) AS lines
  FROM pages),
counts AS (SELECT host, line, count(*) AS n FROM (SELECT DISTINCT r, host, unnest(lines) AS line FROM pages_lines) GROUP BY ALL),
dropped AS (
  SELECT host, list(line) AS lines FROM counts JOIN (SELECT host, count(*) AS pages FROM pages_lines GROUP BY host) USING (host)
  WHERE n >= 3 AND n > 0.3 * pages GROUP BY host),
kept AS (
  SELECT page_id, p.host, len(p.lines) AS n_lines, list_filter(p.lines, lambda x: d.lines IS NULL OR NOT list_contains(d.lines, x)) AS lines
  FROM pages_lines p LEFT JOIN dropped d ON p.host = d.host)
SELECT page_id, host, coalesce(array_to_string(lines, chr(10)), '') AS text, n_lines, n_lines - len(lines) AS n_dropped FROM kept"""


SQL = _sql()
