"""A corpus pipeline of the operators in ``prismframe.llm``.

Quality rules, near duplicates, benchmark decontamination, mixing to target weights, sharding. Each stage works on what
its predecessor kept, written as Parquet in the folder that all executors share and read again.

In all stages null and empty texts, ids, languages and sources are rows like others; empty tables give empty ones; texts
are used whole; columns besides those of documents come along, whatever their names, but for ``shard_id``, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prismframe.llm.common import cut, drop_cut, table
from prismframe.llm.decontamination import decontaminate
from prismframe.llm.mixing import mix_documents
from prismframe.llm.near_duplicates import drop_near_duplicates
from prismframe.llm.quality import reject_outliers
from prismframe.llm.sharding import shard_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are outliers of their language and source go. Texts without words have usual statistics and stay; rows
    that are equal stay or go together.
    """
    return reject_outliers(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that of the least id. Rows without id or words stay; a row that
    repeats an id and its text stays once.
    """
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, give or take its error budget, go. Texts without words stay."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many words as came in, by target weights: a document comes once for every epoch it is in. Null languages and sources
    are leaves of their own; ties in the seeded order come in or stay out together.
    """
    return mix_documents(docs, epoch_col=None)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents and ``shard_id``; copies of a text share a shard, null texts are one group."""
    return shard_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing to target weights", mixing),
    ("sharding", sharding),
]

#: None: covariance estimates, connected components and edit distances are beyond SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
        if before is not None:
            drop_cut(before)  # nothing reads a stage's input once its output is written
        before = docs
    return docs
