"""The daily chain as one plan: items to primaries, clusters, ranked stories, their corpus and term statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls
from ..operators import dedup, stories, terms
from ..operators.hdbscan import hdbscan
from .session import shared_checkpoint


def annotate(items: DataFrame) -> DataFrame:
    """Items (id, day, outlet, country, lang, title, link, summary, body) with their derived columns."""
    signal = X.signal_text(F.col("body"), F.col("summary"), F.col("title"))
    return (
        dedup.annotate(items, "link", "title", "outlet").withColumn("section", urls.infer_section(F.col("link"))).withColumn("is_stub", X.is_stub(F.col("title"), F.col("summary")))
        .withColumn("signal_level", signal["level"]).withColumn("signal_text", signal["text"])
    )


def cluster(items: DataFrame, vectors: DataFrame, min_size: int = 3) -> DataFrame:
    """(day, id, cluster, persistence) of the day's primaries. ``vectors``: id, embedding. Materialised once."""
    keys = dedup.primaries(items, "id", "summary", "outlet").select(F.col("primary_id").alias("id"))
    ready = items.join(keys, "id", "left_semi").select("day", "id").join(vectors, "id")
    return shared_checkpoint(hdbscan(ready, ["day"], "id", "embedding", min_size).filter("cluster >= 0"))


def rank(items: DataFrame, clusters: DataFrame, top: int = 15) -> DataFrame:
    """The day's clusters of three outlets or more by salience."""
    m = clusters.join(items.select("id", "country", "outlet", "lang"), "id").groupBy("day", F.col("cluster").alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("n_articles"), F.count_distinct("country").alias("n_countries"), F.count_distinct("outlet").alias("n_outlets"), F.count_distinct("lang").alias("n_langs")
    )
    total = clusters.join(items.select("id", "country"), "id").agg(F.count_distinct("country").alias("all_countries"))
    return stories.salience(m.filter("n_outlets >= 3").withColumn("stability", F.lit(None).cast("double")).crossJoin(total), F.col("all_countries"), top).drop("all_countries")


def corpus(items: DataFrame, clusters: DataFrame, ranked: DataFrame) -> DataFrame:
    """Per story and outlet its two most telling articles, with the position that citations point to."""
    members = clusters.join(ranked.select("day", F.col("cluster_id").alias("cluster")), ["day", "cluster"], "left_semi").join(items.drop("day"), "id")
    words = members.withColumn("_w", X.title_tokens(F.col("title"))).withColumn("_n", F.length("signal_text"))
    kept = stories.novel_articles(words, ["day", "cluster", "outlet"], "_w", "signal_level", "_n", "id")
    ordered = kept.join(items.drop("day", "outlet"), "id")
    idx = ordered.groupBy("day", "cluster").agg(F.array_sort(F.collect_list(F.struct("outlet", "kept_rank", "id"))).alias("x")).select("day", "cluster", F.posexplode("x").alias("signal_text_idx", "x")).select("day", "cluster", "signal_text_idx", F.col("x.id").alias("id"))
    return idx.join(ordered, ["day", "cluster", "id"])


def metrics(story_corpus: DataFrame) -> dict[str, DataFrame]:
    """Distinctive words and word pairs, and exclusive vocabulary, of each story's buckets."""
    read = story_corpus.filter("section <> 'opinion'").select(F.concat_ws("|", "day", "cluster", "country").alias("bucket"), F.concat_ws("|", "day", "cluster", "lang").alias("lang"), X.tokens(F.concat_ws("\n", "title", "signal_text")).alias("w"))
    words, pairs = terms.counts(read, ["bucket", "lang"], F.col("w")), terms.counts(read, ["bucket", "lang"], X.bigrams(F.col("w")))
    return {
        "words": terms.log_likelihood(terms.against_cohort(words), ["bucket", "lang"]),
        "pairs": terms.log_odds_terms(terms.against_cohort(pairs), ["bucket", "lang"]),
        "exclusive": terms.exclusive(words.groupBy("bucket", "term").agg(F.sum("n").alias("n"))),
    }


def run(items: DataFrame, vectors: DataFrame, top: int = 15) -> dict[str, DataFrame]:
    """Everything a day gives, by name."""
    annotated = annotate(items)
    clusters = cluster(annotated, vectors)
    ranked = rank(annotated, clusters, top)
    told = shared_checkpoint(corpus(annotated, clusters, ranked))
    return {"items": annotated, "clusters": clusters, "stories": ranked, "corpus": told, **metrics(told)}
