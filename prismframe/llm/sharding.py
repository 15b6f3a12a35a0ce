"""Sharding: best-fit-decreasing packing of indivisible groups into shards of a fixed capacity.

Groups of equal size are interchangeable, so the sequential part runs on the histogram of sizes (at most ``capacity``
distinct values, whatever the number of groups): largest size first, each item into the open shard with the tightest
remaining capacity, found in a balanced tree keyed by remaining capacity; shards with equal remainders are handled as
runs. What comes back is a short list of rank intervals per size, which the groups join by size and rank. Nothing but
sizes and counts reaches the driver: with the capacity of 8 MB at most 8,388,608 sizes and those above it, 16 bytes each.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, cut, table

#: Ranks are counted within this many hash slices of each size, so that a size shared by very many groups is no single task.
SLICES = 64


class Treap:
    """Balanced search tree: insert, remove, and the least key not below a bound, each in expected logarithmic time."""

    def __init__(self, seed: int = 7):
        self.root: list | None = None  # [key, priority, left, right]
        self.random = random.Random(seed).random

    def _split(self, node, key):
        """Keys below ``key``, the rest."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def insert(self, key: int) -> None:
        left, right = self._split(self.root, key)
        self.root = self._merge(self._merge(left, [key, self.random(), None, None]), right)

    def remove(self, key: int) -> None:
        left, rest = self._split(self.root, key)
        _, right = self._split(rest, key + 1)
        self.root = self._merge(left, right)

    def ceiling(self, bound: int) -> int | None:
        node, found = self.root, None
        while node is not None:
            if node[0] >= bound:
                found, node = node[0], node[2]
            else:
                node = node[3]
        return found


def pack_histogram(histogram: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit-decreasing over (size, count). Rows (size, first rank, end rank, first shard, items a shard).

    Items of one size fill a shard as long as they fit, since the shard just used is then the tightest. A size above
    the capacity gets shards of its own.
    """
    tree, runs, shards, rows = Treap(), {}, 0, []

    def keep(room: int, first: int, n: int) -> None:
        if n and room not in runs:
            runs[room] = []
            tree.insert(room)
        if n:
            runs[room].append((first, n))

    for size, count in sorted(histogram, reverse=True):
        if size > capacity:
            rows.append((size, 0, count, shards, 1))
            shards += count
            continue
        rank = 0
        while rank < count:
            room = tree.ceiling(size)
            if room is None:
                each = capacity // size if size else count
                first, n = shards, -(-(count - rank) // each)
                shards, room = shards + n, capacity
            else:
                first, n = runs[room].pop()
                if not runs[room]:
                    del runs[room]
                    tree.remove(room)
                each = room // size if size else count
            used = min(n, -(-(count - rank) // each))
            end = min(count, rank + used * each)
            rows.append((size, rank, end, first, each))
            last = (end - rank) - (used - 1) * each
            keep(room - each * size, first, used - 1)
            keep(room - last * size, first + used - 1, 1)
            keep(room, first + used, n - used)
            rank = end
    return rows


def shard(docs: DataFrame, capacity: int, group: Column, size: Column) -> DataFrame:
    """``docs`` with ``shard_id`` (BIGINT) at the end; an input column of that name is replaced.

    ``group`` names the indivisible groups (null is a group like any other), ``size`` a row's size in the units of
    ``capacity`` (null or negative: 0). Rows of a group always share a shard. A group above ``capacity`` has a shard of
    its own. Groups of equal size rank by a hash of their name: the result depends on the rows and not on their order.
    Repeated rows count each; an empty table gives an empty one. Rows are read twice: once for the table of groups, which
    all that follows reads, and once to join their shard.
    """
    spark = docs.sparkSession
    name = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("null"))
    key = F.unhex(F.md5(name))
    rows = docs.select(key.alias("g"), F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("s"))
    groups = cut(rows.groupBy("g").agg(F.sum("s").alias("s")).withColumn("slice", F.pmod(F.xxhash64("g"), F.lit(SLICES))))
    counts = groups.groupBy("s", "slice").agg(F.count(F.lit(1)).alias("n"))
    histogram = counts.groupBy("s").agg(F.sum("n").alias("n")).toPandas()
    plan = pack_histogram([(int(s), int(n)) for s, n in histogram.itertuples(index=False)], capacity)
    intervals = spark.createDataFrame(pd.DataFrame(plan, columns=["s", "lo", "hi", "first", "each"], dtype="int64"), "s long, lo long, hi long, first long, each long")
    offsets = counts.select("s", "slice", (F.sum("n").over(W.partitionBy("s").orderBy("slice")) - F.col("n")).alias("before"))
    ranked = (
        groups.withColumn("r", F.row_number().over(W.partitionBy("s", "slice").orderBy("g")) - 1)
        .join(offsets, ["s", "slice"])
        .select("g", "s", (F.col("r") + F.col("before")).alias("r"))
    )
    placed = ranked.join(intervals, "s").filter("r >= lo AND r < hi").select("g", F.expr("first + (r - lo) div each").alias("shard"))
    kept = [c for c in docs.columns if c != "shard_id"]
    left = docs.select(key.alias("g"), F.struct(*[col(c) for c in kept]).alias("row"))
    return left.join(placed, "g").select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("shard").alias("shard_id"))


#: Bytes of text a shard holds.
CAPACITY = 8 << 20


def shard_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``docs`` with ``shard_id``. Exact copies of a text are one indivisible group; its size is their bytes of UTF-8.

    Null texts are one group of size 0, as are empty ones; a text longer than ``capacity`` has a shard of its own with its
    copies. Repeated rows, empty tables and clashing names as in ``shard``.
    """
    return shard(docs, capacity, F.col("text"), F.octet_length("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
