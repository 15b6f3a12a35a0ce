"""Where queries and their SQL are registered, and the roles that the driver's tables play."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function by its name, with the SQL that gives the same rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as articles: source is the outlet, the first line the title, the second the summary; five countries, thirty days, seventeen stories."""
    d = read(spark, sf_dir, "documents")
    no = F.substring("source", 4, 9).cast("int")
    return d.select(
        "doc_id", F.col("text").alias("body"), "lang", F.col("source").alias("outlet"), F.concat(F.lit("c"), (no % 5).cast("string")).alias("country"),
        F.substring_index("text", "\n", 1).alias("title"), F.coalesce(F.try_element_at(F.split("text", "\n"), F.lit(2)), F.lit("")).alias("summary"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.expr("doc_id div 7 % 30").cast("int")).alias("day"), F.concat(F.lit("s"), (F.col("doc_id") % 17).cast("string")).alias("story"),
        F.when(no % 7 == 0, "opinion").otherwise("news").alias("section"),
    )


ARTICLES = """articles AS (SELECT doc_id, text AS body, lang, source AS outlet, 'c' || CAST(CAST(substr(source, 4) AS INT) % 5 AS VARCHAR) AS country,
  split_part(text, chr(10), 1) AS title, coalesce(split_part(text, chr(10), 2), '') AS summary, DATE '2024-01-01' + CAST(doc_id // 7 % 30 AS INT) AS day,
  's' || CAST(doc_id % 17 AS VARCHAR) AS story, CASE WHEN CAST(substr(source, 4) AS INT) % 7 = 0 THEN 'opinion' ELSE 'news' END AS section FROM documents)"""


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as coverage facts: type is the story, twelve buckets of users, a day."""
    e = read(spark, sf_dir, "events")
    return e.select("event_id", F.to_date("ts").alias("day"), F.col("event_type").alias("story"), F.concat(F.lit("b"), (F.col("user_id") % 12).cast("string")).alias("bucket"), F.col("user_id").alias("feed"), "value", "props", "ts")


FACTS = "facts AS (SELECT event_id, CAST(ts AS DATE) AS day, event_type AS story, 'b' || CAST(user_id % 12 AS VARCHAR) AS bucket, user_id AS feed, value, props, ts FROM events)"


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as attributed quotes: role is the speaker type, turn the position."""
    c = read(spark, sf_dir, "conversations")
    n = F.length(F.coalesce("text", F.lit("")))
    return c.select(
        F.col("conv_id").alias("story"), F.col("turn").alias("idx"), F.col("role").alias("speaker_type"), F.col("text").alias("quote"),
        F.concat(F.lit("o"), (F.col("conv_id") % 9).cast("string")).alias("outlet"), F.concat(F.lit("b"), (F.col("conv_id") % 4).cast("string")).alias("bucket"),
        F.when(n % 3 == 0, "for").when(n % 3 == 1, "against").otherwise("neutral").alias("stance"), F.concat(F.lit("f"), (n % 5).cast("string")).alias("frame"),
    )


QUOTES = """quotes AS (SELECT conv_id AS story, turn AS idx, role AS speaker_type, text AS quote, 'o' || CAST(conv_id % 9 AS VARCHAR) AS outlet, 'b' || CAST(conv_id % 4 AS VARCHAR) AS bucket,
  CASE length(coalesce(text, '')) % 3 WHEN 0 THEN 'for' WHEN 1 THEN 'against' ELSE 'neutral' END AS stance, 'f' || CAST(length(coalesce(text, '')) % 5 AS VARCHAR) AS frame FROM conversations)"""


def _singular(x: str) -> str:
    out = x
    for suffix in reversed(X.PLURALS):
        n = len(suffix)
        out = f"CASE WHEN suffix({x}, '{suffix}') AND length({x}) - {n} >= 4 AND length({x}) > 4 THEN left({x}, length({x}) - {n}) ELSE {out} END"
    return out


_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in X.STOPWORDS) + "]"


def tokens_sql(text: str) -> str:
    words = f"list_transform(regexp_extract_all(coalesce({text}, ''), '\\p{{L}}{{4,}}'), lambda t: lower(t))"
    return f"list_filter(list_transform({words}, lambda w: {_singular('w')}), lambda w: length(w) >= 4 AND NOT list_contains({_STOP}, w))"


def bigrams_sql(words: str) -> str:
    return f"list_transform(list_zip(({words})[:-2], ({words})[2:]), lambda p: p[1] || ' ' || p[2])"


def title_tokens_sql(title: str) -> str:
    stop = "[" + ", ".join(f"'{w}'" for w in X.TITLE_STOPWORDS) + "]"
    return f"list_distinct(list_filter(regexp_extract_all(lower(coalesce({title}, '')), '[a-z]{{4,}}'), lambda w: NOT list_contains({stop}, w)))"


def g2_sql() -> str:
    n = "(a + b)"
    all_ = "CAST(total_a + total_b AS DOUBLE)"

    def cell(seen: str, row: str, column: str) -> str:
        return f"(CASE WHEN {seen} > 0 THEN {seen} * ln({seen} * {all_} / (CAST({row} AS DOUBLE) * {column})) ELSE 0 END)"

    return f"2 * ({cell('a', n, 'total_a')} + {cell('b', n, 'total_b')} + {cell('(total_a - a)', f'({all_} - {n})', 'total_a')} + {cell('(total_b - b)', f'({all_} - {n})', 'total_b')})"


LOG_ODDS = "(ln((a + 0.5) / greatest(total_a - a, 1e-9)) - ln((b + 0.5) / greatest(total_b - b, 1e-9)))"
Z = f"({LOG_ODDS} / sqrt(1 / (a + 0.5) + 1 / (b + 0.5)))"
