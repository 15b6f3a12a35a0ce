"""Mixing to target weights: a token budget flows down a domain-language-source tree to seeded prefixes of documents.

Every node splits what it gets among its children by weight. A child that can't use its share (its documents times the
allowed epochs) takes what it can, and the shortage goes to its siblings by weight; only what the siblings can't take
either is left to the parent's siblings. A leaf with a quota of ``e`` whole epochs and a rest takes all its documents
``e`` times and, of the epoch after those, the longest prefix in that epoch's seeded order that fits the rest.

The tree has one row per leaf and is all that reaches the driver. Prefixes need no global sort: hashes fall into
slices, slice totals tell which slices lie inside the prefix, and only the slice on its edge is sorted.
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, cut, table

LEVELS = ("domain", "lang", "source")
#: Documents a slice holds about.
SLICE_DOCS = 5_000


def fill(amount: float, children: list[tuple[float, float]]) -> list[float]:
    """``amount`` split over (weight, capacity) by weight, shortages going to the siblings that have room.

    Siblings of weight 0 get something only when those with a weight are full; they share by capacity.
    """
    got, open_ = [0.0] * len(children), [i for i, (w, c) in enumerate(children) if w > 0 and c > 0]
    left = min(amount, sum(c for _, c in children))
    while open_ and left > 0:
        total = sum(children[i][0] for i in open_)
        full = [i for i in open_ if children[i][1] <= left * children[i][0] / total]
        if not full:
            for i in open_:
                got[i] = left * children[i][0] / total
            return got
        for i in full:
            got[i] = children[i][1]
        left -= sum(got[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    rest = [i for i, (w, c) in enumerate(children) if w <= 0 and c > 0]
    room = sum(children[i][1] for i in rest)
    for i in rest:
        got[i] = min(left, room) * children[i][1] / room
    return got


def leaf_quotas(tokens: dict[tuple, int], weights: Mapping[tuple, float], budget: float, max_epochs: float) -> dict[tuple, int]:
    """Whole tokens for each leaf path. A node without a weight of its own weighs 1."""
    quotas: dict[tuple, int] = {}

    def down(prefix: tuple, leaves: dict[tuple, int], amount: float) -> None:
        if len(prefix) == len(next(iter(leaves))):
            quotas[prefix] = int(amount + 1e-6)
            return
        below: dict[tuple, dict] = {}
        for path, n in leaves.items():
            below.setdefault(path[: len(prefix) + 1], {})[path] = n
        order = sorted(below, key=str)
        shares = fill(amount, [(weights.get(p, 1.0), sum(below[p].values()) * max_epochs) for p in order])
        for p, share in zip(order, shares, strict=True):
            down(p, below[p], share)

    if tokens:
        down((), tokens, budget)
    return quotas


def mix(
    docs: DataFrame, weights: Mapping[tuple, float], domain: Column, tokens: Column, budget: float | None = None,
    max_epochs: float = 4.0, seed: int = 17, id_col: str = "doc_id", lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
    epoch_col: str | None = "epoch",
) -> DataFrame:
    """The chosen rows of ``docs``, once per epoch they are in, with the epoch's number in ``epoch_col`` (None: without).

    ``budget``: tokens wanted, by default all that there are; ``tokens``: a row's count (null or negative: 0). A null
    domain, language or source is a node of its own. Order within an epoch is a hash of seed, epoch and id; ties (null
    or repeated ids) follow the text's hash, and rows equal in both come in or stay out together. A leaf without tokens
    gives no rows.
    An empty table gives an empty one. Input columns named like the epoch column are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c != epoch_col]
    leaf = F.struct(*[F.coalesce(F.concat(F.lit("="), x.cast("string")), F.lit("")).alias(n) for n, x in zip(LEVELS, (domain, col(lang_col), col(source_col)), strict=True)])
    read = docs.select(F.struct(*[col(c) for c in kept]).alias("row"), leaf.alias("leaf"), F.greatest(F.coalesce(tokens, F.lit(0)), F.lit(0)).cast("long").alias("t"), col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("h"))
    # the one pass that counts tokens; everything up to the choice of rows works on this slim table
    counted = cut(read.select("leaf", "id", "h", "t"))
    leaves = counted.groupBy("leaf").agg(F.sum("t").alias("t"), F.count(F.lit(1)).alias("n")).select("leaf.*", "t", "n").collect()
    have = {tuple(x[1:] if x else None for x in r[:3]): r["t"] for r in leaves if r["t"] > 0}
    quotas = leaf_quotas(have, weights, sum(have.values()) if budget is None else budget, max_epochs)
    plan = []
    for r in leaves:
        path = tuple(x[1:] if x else None for x in r[:3])
        if quotas.get(path, 0) > 0:
            plan.append((*r[:3], quotas[path] // r["t"], quotas[path] % r["t"], -(-r["n"] // SLICE_DOCS)))
    names = ["domain", "lang", "source", "full", "rest", "slices"]
    shape = "domain string, lang string, source string, full long, rest long, slices long"
    chosen = spark.createDataFrame(pd.DataFrame(plan, columns=names), shape).select(F.struct("domain", "lang", "source").alias("leaf"), "full", "rest", "slices")
    order = F.xxhash64(F.lit(seed), F.col("full"), F.col("id"))
    at = F.struct("order", "h")
    sliced = counted.join(chosen, "leaf").withColumn("order", order)
    sliced = sliced.withColumn("slice", F.floor((F.col("order").cast("double") / F.lit(2.0**64) + F.lit(0.5)) * F.col("slices")).cast("long"))
    # windows see slim rows only; each leaf's prefix comes down to its last row, and texts never leave their partition
    slim = sliced.select("leaf", "slice", "rest", "order", "h", "t")
    totals = slim.groupBy("leaf", "slice").agg(F.sum("t").alias("here"), F.max(at).alias("last"), F.first("rest").alias("rest"))
    earlier = W.partitionBy("leaf").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    # written, the slices' table has a known size, by which Catalyst picks the join
    before = cut(totals.withColumn("before", F.coalesce(F.sum("here").over(earlier), F.lit(0))))
    inside = F.col("before") + F.col("here") <= F.col("rest")
    edge = before.filter(~inside & (F.col("before") <= F.col("rest"))).select("leaf", "slice", "before")
    peers = W.partitionBy("leaf", "slice").orderBy(at).rangeBetween(W.unboundedPreceding, W.currentRow)
    on_edge = slim.join(edge, ["leaf", "slice"]).withColumn("upto", F.col("before") + F.sum("t").over(peers)).filter("upto <= rest")
    lasts = before.filter(inside).select("leaf", "last").unionByName(on_edge.select("leaf", at.alias("last")))
    prefix = cut(lasts.groupBy("leaf").agg(F.max("last").alias("last")))
    chosen_rows = read.drop("t").join(chosen, "leaf").withColumn("order", order).join(prefix, "leaf", "left").withColumn("more", F.coalesce(at <= F.col("last"), F.lit(False)).cast("int"))
    both = chosen_rows.filter(F.col("full") + F.col("more") > 0)
    out = both.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") + F.col("more") - 1)))
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], *([F.col("epoch").alias(epoch_col)] if epoch_col else []))


def words(text: Column) -> Column:
    """White-space separated words; null and blank texts have none."""
    trimmed = F.trim(text)
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"\s+"))).cast("long")


#: Sources belong to four domains by their number.
DOMAINS = ("web", "reference", "forums", "news")


def domain_of(source: Column) -> Column:
    n = F.regexp_extract(source, r"(\d{1,9})$", 1)
    return F.when(n == "", F.lit("other")).otherwise(F.element_at(F.array(*map(F.lit, DOMAINS)), (F.try_to_number(n, F.lit("999999999")).cast("int") % 4 + 1)))


#: Target weights by node: domains, then languages within each domain. Sources weigh the same.
WEIGHTS = {("web",): 0.4, ("reference",): 0.25, ("forums",): 0.1, ("news",): 0.25} | {
    (d, lang): w for d in (*DOMAINS, "other") for lang, w in (("en", 0.6), ("de", 0.15), ("fr", 0.15), ("es", 0.1))
}


def mix_documents(docs: DataFrame, epoch_col: str | None = "epoch") -> DataFrame:
    """``docs`` mixed by ``WEIGHTS`` to as many words as they have. Null and empty texts have no words: they come along with
    their leaf's epochs. Nulls, ties, repeated rows, empty tables and clashing names as in ``mix``; long texts are counted
    whole.
    """
    return mix(docs, WEIGHTS, domain_of(F.col("source")), words(F.col("text")), epoch_col=epoch_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents"))
