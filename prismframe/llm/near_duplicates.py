"""N-gram Jaccard join with parity sketches: every pair at or above the threshold, none below.

A document is the set of its word n-grams. Two sets of a and b n-grams with Jaccard >= t differ in at most
d = (1 - t) / (1 + t) * (a + b) n-grams, and share at least t * a and t * b. Three steps, each without false negatives:

* Pigeonhole. In any order of all n-grams that both sets follow, the first ``n - ceil(t * n) + 1`` of each share one. The
  order is by frequency, rare first, so documents meet at their rarest n-grams and what many share is seldom a key. (Parts
  of a sketch would do too, but at t = 0.6 a band needs n / 2 parts, which hold one or two n-grams each: more keys, most of
  them as frequent as a single common n-gram. README gives the reckoning.) Sizes and what is left after the key rule out
  pairs in the same place; a pair whose previous keys are equal has met there.
* Parity sketch. Every n-gram flips one of w bits, w = 4 n or more, a power of two per size band. The Hamming distance of
  two sketches is at most the symmetric difference, so more than d flipped bits rule a pair out. A wider sketch folds to a
  narrower band by XOR of its halves. Sketches have a sixteenth of the size of the sets, which travel only for what is left.
* Verification by exact Jaccard similarity.

Frequencies come from one table of counters of fixed size, so they may be too high, which costs time but never a pair. Keys
travel sorted and packed, by ranges of the key, about 19 bytes each. Equal sets are one node until the end: copies of a text cost
one row each. For the pipeline, links close to groups by large-star and small-star steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, cut, drop_cut, table
from .text_arrays import WORD_BYTES, Texts, byte_sizes, mix

#: At 0.6 a short text with one line added is still a copy; texts that share no origin stay below 0.4.
THRESHOLD, NGRAM = 0.6, 2
#: Counters of n-grams, a byte each, and how many of them travel in a row.
COUNTERS, CHUNK = 1 << 27, 1 << 20
#: Rows of a key that one task compares with one another, about; a key that more documents hold is split into tiles.
HOT_ROWS = 1 << 15
#: Pairs that are kept before repeats among them are dropped, and pairs that one task verifies, about.
HELD, TILE_PAIRS = 1 << 20, 100_000
#: Keys that are sorted and packed at once, about.
FLUSHED = 1 << 19
#: Bits of the filter of ids that candidates' texts pass before their exact join: 16 MB at most.
FILTER_BITS = 1 << 27
SLICE = 1 << 20


def gram_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The distinct n-gram hashes of each text, sorted. A text of fewer than n words has one n-gram: all of it."""
    ahead, at = np.cumsum(byte_sizes(texts)), 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ahead, (ahead[at - 1] if at else 0) + SLICE, "right")))
        hashes, first, _ = Texts(texts.slice(at, to - at), lower=True).words(WORD_BYTES)
        with np.errstate(over="ignore"):
            grams = hashes.copy()
            for i in range(1, n):
                grams = mix(grams[: len(hashes) - i] * np.uint64(0x9FB21C651E98DF25) + hashes[i:]) if len(hashes) > i else grams[:0]
            for a, b in zip(first[:-1], first[1:], strict=True):
                if b - a >= n:
                    yield np.unique(grams[a : b - n + 1])
                elif b > a:
                    short = hashes[a:b]
                    yield mix(np.array([np.bitwise_xor.reduce(short * np.arange(3, 3 + 2 * len(short), 2, dtype=np.uint64))], np.uint64))
                else:
                    yield hashes[:0]
        at = to


def _slots(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64(COUNTERS - 1)).astype(np.int64)


def coded(counts: np.ndarray) -> np.ndarray:
    """Counts in a byte, in order: exact to 127, then eight steps to the doubling."""
    codes = np.minimum(counts, 127).astype(np.uint8)
    high = np.flatnonzero(counts > 127)
    codes[high] = np.minimum(127 + np.ceil(8 * np.log2(counts[high] / 127.0)), 255).astype(np.uint8)
    return codes


def decoded(codes: np.ndarray) -> np.ndarray:
    return np.where(codes <= 127, codes, 127 * 2.0 ** ((codes.astype(float) - 127) / 8))


def prefix(grams: np.ndarray, t: float, counters: np.ndarray | None = None) -> np.ndarray:
    """The prefix of a set in order of frequency: its first ``n - ceil(t * n) + 1`` n-grams."""
    n = len(grams)
    least = n - math.ceil(t * n - 1e-9) + 1
    count = np.zeros(n, np.uint64) if counters is None else counters[_slots(grams)].astype(np.uint64)
    # the count, then the hash: of one count the top bits decide, and equal ones keep the order of the hash
    return grams[np.argsort((count << np.uint64(56)) | (grams >> np.uint64(8)), kind="stable")[:least]]


def part_keys(grams: np.ndarray, t: float) -> np.ndarray:
    """Keys that a set is joined by when no frequencies are known."""
    return prefix(grams, t)


def _node(grams: np.ndarray) -> int:
    """One number for a set: equal sets are one node."""
    return int(mix(np.array([np.bitwise_xor.reduce(grams) ^ mix(np.array([np.bitwise_xor.reduce(mix(grams + np.uint64(77)))], np.uint64))[0]], np.uint64)).view(np.int64)[0])


def sketch(grams: np.ndarray) -> np.ndarray:
    """Four bytes of the set's size, then those of its parity sketch: every n-gram flips one of at least 4 n bits."""
    bits = 64 << max(0, math.ceil(math.log2(len(grams) / 16)))
    at = (grams >> np.uint64(33)) & np.uint64(bits - 1)
    parity = np.packbits((np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8))
    return np.concatenate([np.array([len(grams)], np.uint32).view(np.uint8), parity])


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """The sketch of the same set in ``size`` bytes. Bit i of the narrow one is the parity of all bits i modulo its width."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def hamming(p: np.ndarray, q: np.ndarray) -> int:
    """Bits that the sketches of two sets differ in, at the narrower width: at most their symmetric difference."""
    p, q = (p[4:], q[4:]) if len(p) <= len(q) else (q[4:], p[4:])
    return int(np.bitwise_count((p ^ (q if len(q) == len(p) else fold(q, len(p)))).view(np.uint64)).sum())


def _packed(counts: np.ndarray) -> bytes:
    return pa.compress(counts.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, size: int = 1) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, CHUNK * size, "zstd", asbytes=True), np.uint8 if size == 1 else np.uint32)


def _id_type(docs: DataFrame) -> pa.DataType:
    return docs.select("id").limit(0).toArrow().schema.field(0).type


def _counted(docs: DataFrame, n: int) -> tuple[DataFrame, list[tuple[int, bytes]]]:
    """(id, node, sketch) of every text with words, and by chunk how many texts hold the n-grams of each counter, coded.

    A task counts to 255, so that of an n-gram in nearly every document is a lower bound: it comes late in the order still.
    """
    schema = T.StructType([T.StructField("id", docs.schema["id"].dataType), T.StructField("node", T.LongType()), T.StructField("sketch", T.BinaryType()), T.StructField("chunk", T.IntegerType()), T.StructField("counts", T.BinaryType())])
    id_type = _id_type(docs)

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, seen = np.zeros(COUNTERS, np.uint8), set()
        for batch in rows:
            at, node, bits, held, size = [], [], [], [], 0
            for i, grams in enumerate(gram_sets(batch.column(1), n)):
                if len(grams):
                    at.append(i)
                    node.append(x := _node(grams))
                    bits.append(None if x in seen else sketch(grams).tobytes())
                    seen.add(x)
                    held.append(_slots(grams))
                    size += len(grams)
                if held and (size >= HELD or i == len(batch) - 1):
                    slot, times = np.unique(np.concatenate(held), return_counts=True)
                    found[slot] = np.minimum(found[slot] + times, 255)
                    held, size = [], 0
            m = len(at)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(node, pa.int64()), pa.array(bits, pa.binary()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=schema.names)
        for i in range(COUNTERS // CHUNK):
            part = found[i * CHUNK : (i + 1) * CHUNK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([i], pa.int32()), pa.array([_packed(part)], pa.binary())], names=schema.names)

    def merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in rows:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[chunk] = sums.get(chunk, np.uint32(0)) + _unpacked(data).astype(np.uint32)
        for chunk, counts in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([_packed(coded(counts))], pa.binary())], names=["chunk", "counts"])

    both = cut(docs.mapInArrow(count, schema))
    merged = both.filter("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk").mapInArrow(merge, "chunk int, counts binary")
    return both.filter("chunk IS NULL").select("id", "node", "sketch"), [(r.chunk, bytes(r.counts)) for r in merged.collect()]


def _lists(arrays: list[np.ndarray], dtype: type) -> pa.ListArray:
    lengths = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(arrays).astype(dtype, copy=False) if arrays else np.zeros(0, dtype)))


def _tiles(keys: np.ndarray, node: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the key, key of the tile): one each, but for keys of more than ``HOT_ROWS`` documents. Their documents
    fall into blocks, and a tile holds two of them, so that every two documents share one.
    """
    sides = np.maximum(1, np.ceil(decoded(codes) / HOT_ROWS)).astype(np.int64)
    if (sides == 1).all():
        return np.arange(len(keys)), keys
    at = np.repeat(np.arange(len(keys)), sides)
    side = sides[at]
    other = np.arange(len(at)) - np.repeat(np.cumsum(sides) - sides, sides)
    own = (mix(keys[at] ^ np.uint64(node & (1 << 64) - 1)) >> np.uint64(1)).astype(np.int64) % side
    low, high = np.minimum(own, other), np.maximum(own, other)
    split = mix(keys[at] ^ mix((low * side + high + 1).astype(np.uint64)))
    return at, np.where(side == 1, keys[at], split)


#: What is known of a key, but for the node: 48 bits of an n-gram or its tile, the set's size, the n-gram's place as a share
#: of the size in 255ths, rounded down, and 32 bits of the previous key (0: none). Keys that collide cost time.
KEY = [("key", np.uint64), ("node", np.int64), ("size", np.uint32), ("place", np.uint8), ("before", np.uint32)]


def key_rows(grams: np.ndarray, node: int, t: float, counters: np.ndarray) -> list[np.ndarray]:
    """The columns of ``KEY`` for one set."""
    keys, n = prefix(grams, t, counters), len(grams)
    before = np.concatenate([np.zeros(1, np.uint32), (keys[:-1] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)])
    at, tile = _tiles(keys, node, counters[_slots(keys)])
    return [tile >> np.uint64(16), np.full(len(at), node), np.full(len(at), n, np.uint32), (at * 255 // n).astype(np.uint8), before[at]]


def _split(column: np.ndarray, size: int) -> bytes:
    """The low ``size`` bytes of every value, byte by byte, so that the high ones compress."""
    return np.ascontiguousarray(column.view(np.uint8).reshape(-1, column.itemsize)[:, :size].T).tobytes()


def pack(columns: list[np.ndarray]) -> bytes:
    """Columns of ``KEY`` in order of the key."""
    key, node, size, place, before = columns
    small = pa.compress(_split(np.diff(key, prepend=np.uint64(0)), 6) + _split(size, 4) + place.tobytes(), "zstd", asbytes=True)
    return small + node.tobytes() + before.tobytes()


def unpack(data: memoryview, n: int) -> list[np.ndarray]:
    end = len(data) - 12 * n
    small = np.frombuffer(pa.decompress(data[:end], 11 * n, "zstd", asbytes=True), np.uint8)
    delta, size = np.zeros((n, 8), np.uint8), np.empty((n, 4), np.uint8)
    delta[:, :6], size[:] = small[: 6 * n].reshape(6, n).T, small[6 * n : 10 * n].reshape(4, n).T
    return [np.cumsum(delta.view(np.uint64)[:, 0], dtype=np.uint64), np.frombuffer(data[end : end + 8 * n], np.int64), size.view(np.uint32)[:, 0], small[10 * n :], np.frombuffer(data[end + 8 * n :], np.uint32)]


def _keys(docs: DataFrame, counts: list[tuple[int, bytes]], t: float, n: int) -> DataFrame:
    """(bucket, n, keys): packed keys by range of the key. Copies of a text give their keys once a partition."""
    spark = docs.sparkSession
    packed, buckets = spark.sparkContext.broadcast(counts), 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = np.array([(i << 48) // buckets for i in range(buckets + 1)], np.uint64)

    def flush(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        order = np.argsort(columns[0], kind="stable")
        columns = [c[order] for c in columns]
        ends = np.searchsorted(columns[0], edges)
        some = np.flatnonzero(np.diff(ends))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(np.diff(ends)[some], pa.int32()), pa.array([pack([c[ends[b] : ends[b + 1]] for c in columns]) for b in some], pa.binary())], names=["bucket", "n", "keys"])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, seen = np.zeros(COUNTERS, np.uint8), set()
        for chunk, data in packed.value:
            counters[chunk * CHUNK : (chunk + 1) * CHUNK] = _unpacked(data)
        held, many = [], 0
        for batch in rows:
            for grams in gram_sets(batch.column(1), n):
                if len(grams) and (x := _node(grams)) not in seen:
                    seen.add(x)
                    held.append(key_rows(grams, x, t, counters))
                    many += len(held[-1][0])
                    if many >= FLUSHED:
                        yield from flush(held)
                        held, many = [], 0
        if held:
            yield from flush(held)

    return docs.mapInArrow(batches, "bucket int, n int, keys binary")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """(at, node, grams): the set of every text in ``docs`` (text, node, tiles) that is its node's, for each of its tiles.

    Copies of a text come once a partition.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in rows:
            at, nodes, held, size = [], [], [], 0
            for grams, node, tiles in zip(gram_sets(batch.column(0), n), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if node not in seen and len(grams) and _node(grams) == node:
                    seen.add(node)
                    for tile in tiles:
                        at.append(tile)
                        nodes.append(node)
                        held.append(grams.view(np.int64))
                        size += len(grams)
                        if size >= HELD:
                            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(nodes, pa.int64()), _lists(held, np.int64)], names=["at", "node", "grams"])
                            at, nodes, held, size = [], [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(nodes, pa.int64()), _lists(held, np.int64)], names=["at", "node", "grams"])

    return docs.select("text", "node", "tiles").mapInArrow(batches, "at long, node long, grams array<long>")


def _met(rows: list[np.ndarray], t: float) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes that share a key, of all rows (``KEY``) of the keys in them."""
    key, node, size, place, before = rows
    size = size.astype(np.int64)
    left = size - place.astype(np.int64) * size // 255
    order = np.lexsort((node, size, key))
    key, node, size, left, before = (c[order] for c in (key, node, size, left, before))
    once = np.ones(len(key), bool)  # copies from several partitions stand side by side
    once[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node, size, left, before = (c[once] for c in (key, node, size, left, before))
    shared = np.zeros(len(key), bool)  # nothing meets at a key of one document
    shared[1:] = key[1:] == key[:-1]
    shared[:-1] |= shared[1:]
    key, node, size, left, before = (c[shared] for c in (key, node, size, left, before))
    names, number = np.unique(node, return_inverse=True)
    found, held, lag, x = [np.zeros(0, np.int64)], 0, 0, np.arange(len(key))
    while len(x):
        lag += 1
        x = x[x + lag < len(key)]
        y = x + lag
        near = (key[x] == key[y]) & (size[x] >= size[y] * t - 1e-6)  # in order of size: who is too large stays so
        x, y = x[near], y[near]
        ok = (np.minimum(left[x], left[y]) >= t / (1 + t) * (size[x] + size[y]) - 1e-6) & (node[x] != node[y]) & ((before[x] != before[y]) | (before[x] == 0))
        a, b = number[x[ok]], number[y[ok]]
        found.append(np.minimum(a, b) << 32 | np.maximum(a, b))
        held += len(a)
        if held > HELD or not len(x):
            pairs = np.unique(np.concatenate(found))
            if len(pairs) > HELD // 2 or not len(x):
                for i in range(0, len(pairs), SLICE):
                    part = pairs[i : i + SLICE]
                    yield pa.RecordBatch.from_arrays([pa.array(names[part >> 32]), pa.array(names[part & 0xFFFFFFFF])], names=["a", "b"])
                pairs = pairs[:0]
            found, held = [pairs], len(pairs)


def _meetings(keys: DataFrame, t: float) -> DataFrame:
    """(a, b), a < b, of nodes that share a key and may reach ``t`` by their sizes and what follows the key. Pairs may repeat."""

    def met(kept: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        yield from _met([np.concatenate(c) for c in zip(*kept, strict=True)], t)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, last = [], None
        for batch in rows:
            for bucket, n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if bucket != last and kept:
                    yield from met(kept)
                    kept = []
                last = bucket
                kept.append(unpack(memoryview(data.as_buffer()), n))
        if kept:
            yield from met(kept)

    return keys.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(batches, "a long, b long")


def _tiled(pairs: DataFrame) -> DataFrame:
    """``pairs`` (a, b) of nodes with a ``tile``: that of the least node next to its first, so copies of one text meet in
    one tile and what is known of a node travels once, not once a pair. Tiles of more than ``TILE_PAIRS`` pairs are split
    by both nodes.
    """
    least = pairs.select("a", F.col("a").alias("x")).unionByName(pairs.select("a", F.col("b").alias("x"))).unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("x")))
    label = least.groupBy("a").agg(F.min("x").alias("label"))
    labelled = pairs.join(label, "a")
    sizes = labelled.groupBy("label").agg(F.ceil(F.sqrt(F.count(F.lit(1)) / TILE_PAIRS)).alias("side"))
    tile = F.xxhash64("label", F.pmod(F.xxhash64("a"), "side"), F.pmod(F.xxhash64("b"), "side"))
    return cut(labelled.join(sizes, "label").select(tile.alias("tile"), "a", "b"))


def _needed(tiled: DataFrame) -> DataFrame:
    """(tile, node) of all nodes of the pairs in a tile."""
    return tiled.select("tile", F.col("a").alias("node")).unionByName(tiled.select("tile", F.col("b").alias("node"))).distinct()


def _by_tile(tiled: DataFrame, right: DataFrame, value: str, test, schema: str) -> DataFrame:
    """``test(pairs, {node: value})`` for the pairs of each tile and what ``right`` (at, node, ``value``) has for it."""

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        column = right.column(value).combine_chunks()
        if pa.types.is_list(column.type):
            flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
        else:
            flat, ends = np.frombuffer(column.buffers()[2] or b"", np.uint8), np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        return test(left, {x: flat[ends[i] : ends[i + 1]] for i, x in enumerate(right.column("node").to_pylist())})

    return tiled.groupBy("tile").cogroup(right.groupBy("at")).applyInArrow(both, schema)


def _sketched(tiled: DataFrame, nodes: DataFrame, t: float) -> DataFrame:
    """The pairs (tile, a, b) whose sketches differ in no more bits than their sets may."""

    def close(left: pa.Table, held: dict[int, np.ndarray]) -> pa.Table:
        a, b = left.column("a").to_pylist(), left.column("b").to_pylist()
        ok = [hamming(held[x], held[y]) <= (1 - t) / (1 + t) * sum(int(held[z][:4].view(np.uint32)[0]) for z in (x, y)) + 1e-6 for x, y in zip(a, b, strict=True)]
        return left.filter(pa.array(ok, pa.bool_()))

    told = _needed(tiled).join(nodes, "node").select(F.col("tile").alias("at"), "node", "sketch")
    return _by_tile(tiled, told, "sketch", close, "tile long, a long, b long")


def _verified(tiled: DataFrame, sets: DataFrame, t: float) -> DataFrame:
    """The pairs (a, b) with their exact ``jaccard``, where it is ``t`` or more."""

    def verify(left: pa.Table, held: dict[int, np.ndarray]) -> pa.Table:
        a, b = left.column("a").to_pylist(), left.column("b").to_pylist()
        out = np.zeros(len(a))
        for i, (x, y) in enumerate(zip(a, b, strict=True)):
            both = np.sort(np.concatenate([held[x].view(np.uint64), held[y].view(np.uint64)]), kind="stable")  # two sorted runs are merged
            shared = int((both[1:] == both[:-1]).sum())
            out[i] = shared / (len(both) - shared)
        return pa.table({"a": left.column("a"), "b": left.column("b"), "jaccard": pa.array(out)}).filter(pa.array(out >= t))

    return _by_tile(tiled, sets, "grams", verify, "a long, b long, jaccard double")


def _of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` (id, text) joined to ``ids`` (id and more). A filter of ``FILTER_BITS`` at most keeps other texts where they
    are; what passes is joined exactly.
    """
    hashed = ids.select(F.xxhash64("id").alias("h"))

    def gather(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in rows:
            at = batch.column(0).to_numpy(zero_copy_only=False) & (FILTER_BITS - 1)
            np.bitwise_or.at(found, at >> 3, (1 << (at & 7)).astype(np.uint8))
        for i in range(0, len(found), CHUNK):
            if found[i : i + CHUNK].any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([_packed(found[i : i + CHUNK])], pa.binary())], names=["chunk", "bits"])

    def merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ors: dict[int, np.ndarray] = {}
        for batch in rows:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ors[chunk] = ors.get(chunk, np.uint8(0)) | _unpacked(data)
        for chunk, bits in ors.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([_packed(bits)], pa.binary())], names=["chunk", "bits"])

    shape = "chunk int, bits binary"
    merged = hashed.mapInArrow(gather, shape).repartition("chunk").mapInArrow(merge, shape).collect()
    packed = docs.sparkSession.sparkContext.broadcast([(r.chunk, bytes(r.bits)) for r in merged])

    def keep(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for chunk, data in packed.value:
            bits[chunk : chunk + CHUNK] = _unpacked(data)
        for batch in rows:
            at = batch.column(2).to_numpy(zero_copy_only=False) & (FILTER_BITS - 1)
            yield batch.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)).select([0, 1])

    passed = docs.select("id", "text", F.xxhash64("id").alias("h")).mapInArrow(keep, docs.select("id", "text").schema)
    return passed.join(ids, "id")


def components(edges: DataFrame) -> DataFrame:
    """(id, group_id) of every node of ``edges`` (a, b): group_id is the least id of its connected component."""
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = F.least(F.min("v").over(W.partitionBy("u")), F.col("u"))
        large = both.withColumn("m", least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = F.min("v").over(W.partitionBy("u"))
        small = large.withColumn("m", low)
        after = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        same = [d.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first() for d in (now, after)]
        drop_cut(now)
        now = after
        if same[0] == same[1]:
            break
    return now.select(F.col("u").alias("id"), F.col("v").alias("group_id")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("group_id")).distinct())


def _joined(docs: DataFrame, t: float, n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of ``docs`` (id, text): (id, node) of every text with words, (node, first) with the least id, and pairs of nodes."""
    docs = docs.filter("id IS NOT NULL AND text IS NOT NULL")
    members, counts = _counted(docs, n)
    # equal sets collapse by aggregation, which combines map-side: a text with millions of copies is no hot task
    nodes = members.groupBy("node").agg(F.min("id").alias("first"))
    tiled = _tiled(cut(_meetings(_keys(docs, counts, t, n), t).distinct()))
    # one sketch a node: copies in other partitions have the same
    sketches = members.filter("sketch IS NOT NULL").groupBy("node").agg(F.max("sketch").alias("sketch"))
    close = cut(_sketched(tiled, sketches, t))
    wanted = _needed(close).groupBy("node").agg(F.collect_list("tile").alias("tiles"))
    held = cut(nodes.join(wanted, "node").select(F.col("first").alias("id"), "node", "tiles"))
    return members.select("id", "node").distinct(), nodes, cut(_verified(close, _sets(_of(docs, held), n), t))


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))


def linked_documents(docs: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``class_id``, ``n_copies``, ``n_links``) of every document that has a copy or a similar text.

    A class is the documents of one n-gram set; ``class_id`` is its least id, ``n_copies`` the other ids in it and
    ``n_links`` how many other classes reach ``threshold`` with it: every such class counts. Words are runs of letters,
    digits and non-ASCII characters in lower case; a text of fewer than ``n`` words is one n-gram. Null texts, texts without
    words and rows without id have no row, nor does an empty table. Rows that repeat an id and its text are one; an id with
    several texts has a row for each. Ties need no rule: similarity is exact. Texts are used whole, whatever their length.
    Other columns are not read, so their names cannot clash.
    """
    members, nodes, similar = _joined(_picked(docs, id_col, text_col), threshold, n)
    links = similar.select(F.col("a").alias("node")).unionByName(similar.select(F.col("b").alias("node"))).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    classes = members.groupBy("node").agg(F.min("id").alias("class_id"), (F.count(F.lit(1)) - 1).alias("n_copies"))
    told = classes.join(links, "node", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long"))).filter("n_copies + n_links > 0")
    return members.join(told, "node").select(F.col("id").alias(id_col), "class_id", "n_copies", "n_links")


def verified_pairs(docs: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM) -> tuple[DataFrame, DataFrame]:
    """Of ``docs`` (id, text): (equal sets linked to their least id, verified pairs with ``jaccard``), both as (a, b)."""
    members, firsts, similar = _joined(docs, threshold, n)
    equal = members.join(firsts, "node").filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    a, b = firsts.select(F.col("node").alias("a"), F.col("first").alias("x")), firsts.select(F.col("node").alias("b"), F.col("first").alias("y"))
    return equal, similar.join(a, "a").join(b, "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"), "jaccard")


def similar_pairs(docs: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``a``, ``b``, ``jaccard``) of every two ids, a < b, whose texts reach ``threshold``; equal sets are pairs of 1.0.

    Words and edge cases as in ``linked_documents``. Of rows that share an id the most similar text counts. As many rows as
    there are pairs: k copies of a text give k (k - 1) / 2.
    """
    members, _, similar = _joined(_picked(docs, id_col, text_col), threshold, n)
    x, y = members.select(F.col("node").alias("a"), F.col("id").alias("x")), members.select(F.col("node").alias("b"), F.col("id").alias("y"))
    apart = similar.join(x, "a").join(y, "b").select("x", "y", "jaccard")
    equal = x.join(y, F.col("a") == F.col("b")).filter("x < y").select("x", "y", F.lit(1.0).alias("jaccard"))
    both = apart.unionByName(equal).filter("x <> y")
    return both.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.max("jaccard").alias("jaccard"))


def near_duplicate_groups(docs: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``group_id``) of every document that is similar to another; ``group_id`` is the least id of the group.

    Similar is transitive here: a group is a connected component of pairs with Jaccard >= ``threshold``. Words and edge
    cases as in ``linked_documents``, but rows that share an id are one node of the graph, whichever text they have.
    """
    equal, similar = verified_pairs(_picked(docs, id_col, text_col), threshold, n)
    found = components(equal.unionByName(similar.select("a", "b")))
    return found.select(F.col("id").alias(id_col), "group_id")


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the least id. Exact repeats of a row's id and text stay once.

    Rows without id, and texts that are null or without words, stay; an empty table gives an empty one.
    """
    gone = near_duplicate_groups(docs, threshold, n, id_col, text_col).filter(col(id_col) != F.col("group_id")).select(col(id_col).alias("id"))
    repeated = docs.select(col(id_col).alias("id")).filter("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")
    marks = cut(gone.withColumn("gone", F.lit(1)).unionByName(repeated.withColumn("gone", F.lit(0))).groupBy("id").agg(F.max("gone").alias("gone")))
    row = docs.select(col(id_col).alias("id"), F.struct(*[col(c) for c in docs.columns]).alias("row"))
    marked = row.join(marks, "id", "left").filter("gone IS NULL OR gone = 0")
    text = F.col("row").getField(text_col)
    once = marked.filter("gone = 0").withColumn("r", F.row_number().over(W.partitionBy("id", F.xxhash64(text), F.crc32(F.coalesce(text, F.lit("")).cast("binary"))).orderBy(F.lit(1)))).filter("r = 1").select("row")
    left = marked.filter("gone IS NULL").select("row").unionByName(once)
    return left.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(table(spark, sf_dir, "documents"))


#: Sets by aggregation of n-grams, classes by equal sets, pairs by all that share an n-gram.
SQL = rf"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
g AS (SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2])) ELSE w END AS g FROM w WHERE len(w) > 0),
m AS (SELECT doc_id, list_sort(g) AS g FROM g), c AS MATERIALIZED (SELECT min(doc_id) AS class_id, count(*) - 1 AS n_copies, len(g) AS n, g FROM m GROUP BY g),
x AS MATERIALIZED (SELECT class_id, n, unnest(g) AS gram FROM c), s AS (SELECT a.class_id AS a, b.class_id AS b, count(*) AS k, max(a.n) AS na, max(b.n) AS nb FROM x a JOIN x b ON a.gram = b.gram AND a.class_id < b.class_id AND a.n >= b.n * {THRESHOLD} - 0.001 AND b.n >= a.n * {THRESHOLD} - 0.001 GROUP BY ALL),
p AS (SELECT a, b FROM s WHERE k / (na + nb - k) >= {THRESHOLD}), l AS (SELECT class_id, count(*) AS n_links FROM (SELECT a AS class_id FROM p UNION ALL SELECT b FROM p) GROUP BY 1)
SELECT m.doc_id, c.class_id, n_copies, coalesce(n_links, 0) AS n_links FROM m JOIN c ON m.g = c.g LEFT JOIN l ON l.class_id = c.class_id WHERE n_copies + coalesce(n_links, 0) > 0"""
