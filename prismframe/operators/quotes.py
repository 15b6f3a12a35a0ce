"""Attributed quotes: roll-ups, dominant frames, agreement of body and headline, grounding in the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rollups(quotes: DataFrame, levels: list[str], dims: list[str]) -> DataFrame:
    """(level, key, dim, value, n) for every level and dimension from one pass with GROUPING SETS."""
    long = quotes.select(*levels, F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in dims])).alias("x")).select(*levels, "x.*")
    sets = [[level, "dim", "value"] for level in levels]
    out = long.groupingSets([[F.col(c) for c in s] for s in sets], *levels, "dim", "value").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid"), *[F.grouping(level).alias(f"g_{level}") for level in levels])
    level = F.coalesce(*[F.when(F.col(f"g_{x}") == 0, F.lit(x)) for x in levels])
    key = F.coalesce(*[F.when(F.col(f"g_{x}") == 0, F.col(x).cast("string")) for x in levels])
    return out.select(level.alias("level"), key.alias("key"), "dim", "value", "n")


def top_values(rolled: DataFrame, k: int = 10) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("level", "key", "dim").orderBy(F.desc("n"), F.col("value").asc_nulls_last()))
    return rolled.withColumn("rank", rank).filter(F.col("rank") <= k)


def dominant(evidence: DataFrame, bucket: str, frame: str, pos: str, listed: DataFrame | None = None) -> DataFrame:
    """(bucket, frame): most evidence, then first seen; buckets without evidence take the first frame that lists them.

    ``listed``: bucket, frame, pos.
    """
    n = evidence.groupBy(bucket, frame).agg(F.count(F.lit(1)).alias("n"), F.min(pos).alias("p"))
    best = n.withColumn("r", F.row_number().over(W.partitionBy(bucket).orderBy(F.desc("n"), "p", frame))).filter("r = 1").select(bucket, frame)
    if listed is None:
        return best
    fallback = listed.groupBy(bucket).agg(F.min_by(frame, F.struct(pos, frame)).alias("_f"))
    return best.join(fallback, bucket, "full_outer").select(bucket, F.coalesce(F.col(frame), F.col("_f")).alias(frame))


def agreement(body: DataFrame, headline: DataFrame, bucket: str, frame: str) -> DataFrame:
    """Per bucket in either: both frames and ``agrees`` (null unless both are known)."""
    return body.select(bucket, F.col(frame).alias("body_frame")).join(headline.select(bucket, F.col(frame).alias("headline_frame")), bucket, "full_outer").withColumn("agrees", F.col("body_frame") == F.col("headline_frame"))


def citation_errors(citations: DataFrame, corpus: DataFrame, idx: str, quote: str, outlet: str, by: list[str]) -> DataFrame:
    """Adds ``error`` and ``outlet_filled`` to citations that point into ``corpus`` (by.., ``idx``, outlet, text) by position.

    Out of range first; then a named outlet that differs; then a quote that is not found verbatim; null if sound. A
    blank or "?" outlet is filled from the corpus. Equi-join on position: no collected corpus array.
    """
    text = corpus.select(*by, F.col(idx), F.col("text").alias("_text"), F.col("outlet").alias("_outlet"))
    joined = citations.join(text, [*by, idx], "left")
    blank = F.coalesce(F.trim(F.col(outlet)), F.lit("")).isin("", "?")
    error = F.when(F.col("_text").isNull(), "out of range").when(~blank & (F.col(outlet) != F.col("_outlet")), "outlet differs").when(~F.col("_text").contains(F.col(quote)), "not found verbatim")
    return joined.withColumn("error", error).withColumn("outlet_filled", F.when(blank, F.col("_outlet")).otherwise(F.col(outlet))).drop("_text", "_outlet")


def rule_errors(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``errors``: the names of the rules that don't hold (null counts as not holding)."""
    failed = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    return rows.withColumn("errors", F.filter(failed, lambda e: e.isNotNull()))


def verbatim(quotes: DataFrame, docs: DataFrame, quote_id: str, quote: str, doc_id: str, text: str) -> DataFrame:
    """(quote_id, n_documents, first_document): documents that hold each quote word for word.

    Anchored instead of testing all pairs: the quote's second to fifth words stand whole in any text that holds it, so
    quotes and documents meet at four-word keys and only those pairs are compared. Shorter quotes are compared with all.
    """
    q = quotes.select(F.col(quote_id).alias("q_id"), F.col(quote).alias("q"), F.split(F.col(quote), " ").alias("w"))
    long = F.size("w") >= 6
    d = docs.select(F.col(doc_id).alias("d_id"), F.col(text).alias("t"))
    w = F.split("t", " ")

    def shifted(k: int) -> Column:
        return F.slice("w", F.lit(k + 1), F.greatest(F.size("w") - 3, F.lit(0)))

    fours = F.zip_with(F.zip_with(shifted(0), shifted(1), lambda a, b: F.concat_ws(" ", a, b)), F.zip_with(shifted(2), shifted(3), lambda a, b: F.concat_ws(" ", a, b)), lambda a, b: F.xxhash64(a, b))
    keys = q.filter(long).select("q_id", F.xxhash64(F.concat_ws(" ", F.col("w")[1], F.col("w")[2]), F.concat_ws(" ", F.col("w")[3], F.col("w")[4])).alias("k"))
    met = d.select("d_id", w.alias("w")).select("d_id", F.explode(F.array_distinct(fours)).alias("k")).join(keys, "k").select("q_id", "d_id").distinct()
    hits = met.join(d, "d_id").join(q.select("q_id", "q"), "q_id").filter(F.col("t").contains(F.col("q"))).select("q_id", "d_id")
    short = q.filter(~long).join(d, F.col("t").contains(F.col("q"))).select("q_id", "d_id")
    found = hits.unionByName(short).distinct()
    return q.select("q_id").join(found, "q_id", "left").groupBy(F.col("q_id").alias(quote_id)).agg(F.count("d_id").alias("n_documents"), F.min("d_id").alias("first_document"))
