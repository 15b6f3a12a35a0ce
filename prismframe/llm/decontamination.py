"""Benchmark decontamination by pigeonhole edit matching.

An item with an error budget of ``k`` edits is split into ``k + 1`` pieces: wherever the item occurs with at most ``k``
edits, one piece occurs unchanged. An Aho-Corasick automaton finds all pieces of all items in one pass over each
document; a hit names the only stretch the occurrence can lie in, and Myers' bit-parallel algorithm computes the least
edit distance of the item to any substring of that stretch.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import col, table

#: Edits allowed, as a share of the item's normalised characters.
ERROR_RATE = 0.08
#: Benchmark characters matched in one pass; a larger benchmark takes several passes, so no automaton outgrows a worker.
CHARS_A_PASS = 8_000_000


def normalise(texts: pa.Array) -> pa.Array:
    """Lower case, letters and digits of any script, all else one space."""
    lowered = pc.utf8_lower(texts.cast(pa.large_string()))
    return pc.utf8_trim(pc.replace_substring_regex(lowered, pattern=r"[^\p{L}\p{N}\p{M}]+", replacement=" "), characters=" ")


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``k + 1`` pieces whose lengths differ by one at most."""
    n, parts = len(item), min(k + 1, len(item))
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(pattern: str) -> dict[str, int]:
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    return at


def myers(at: dict[str, int], n: int, text: str) -> int:
    """Least edit distance of the pattern (``masks``, length) to any substring of ``text``."""
    ones, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best = ones, 0, n, n
    for c in text:
        eq = at.get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        hp = minus | (~(horizontal | plus) & ones)
        hm = plus & horizontal
        if hp & top:
            score += 1
        elif hm & top:
            score -= 1
            if score < best:
                best = score
        hp = hp << 1 & ones
        hm = hm << 1 & ones
        plus = hm | (~(vertical | hp) & ones)
        minus = hp & vertical
    return best


class Matcher:
    def __init__(self, items: list[tuple[object, str]], error_rate: float):
        self.items = []
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            k = int(len(text) * error_rate)
            for offset, piece in pieces(text, k):
                found.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, text, k, masks(text)))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if found:
            self.automaton.make_automaton()
        self.empty = not found

    def hits(self, text: str) -> Iterator[tuple[object, int]]:
        """(item id, distance) of every item that occurs within its budget."""
        if self.empty or not text:
            return
        starts: dict[int, list[int]] = {}
        for end, (length, uses) in self.automaton.iter(text):
            for item, offset in uses:
                starts.setdefault(item, []).append(end + 1 - length - offset)
        for item, at in starts.items():
            item_id, pattern, k, by_char = self.items[item]
            n, best = len(pattern), k + 1
            if any(text.startswith(pattern, s) for s in at if s >= 0):
                yield item_id, 0
                continue
            if k == 0:
                continue
            at.sort()
            low = high = at[0]
            for s in (*at[1:], None):
                if s is not None and s - k <= high + n + k:
                    high = s
                    continue
                best = min(best, myers(by_char, n, text[max(0, low - k) : high + n + k]))
                low = high = s
            if best <= k:
                yield item_id, best


_matchers: dict[str, Matcher] = {}


def _passes(benchmark: DataFrame, item_col: str, text_col: str, error_rate: float, chars: int) -> Iterator[tuple]:
    """(name, broadcast) of the benchmark's normalised items, each of at most about ``chars`` characters."""
    spark = benchmark.sparkSession
    part: list[tuple[object, str]] = []
    size = 0
    for row in benchmark.select(col(item_col).alias("i"), col(text_col).alias("t")).filter("t IS NOT NULL").toLocalIterator():
        text = normalise(pa.array([row["t"]])).to_pylist()[0]
        if text:
            part.append((row["i"], text))
            size += len(text)
            if size >= chars:
                yield uuid.uuid4().hex, spark.sparkContext.broadcast((part, error_rate))
                part, size = [], 0
    yield uuid.uuid4().hex, spark.sparkContext.broadcast((part, error_rate))


def _matcher(name: str, shared) -> Matcher:
    """Built once per worker and pass."""
    if name not in _matchers:
        _matchers.clear()
        _matchers[name] = Matcher(*shared.value)
    return _matchers[name]


def contamination(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", chars_a_pass: int = CHARS_A_PASS,
) -> DataFrame:
    """(id, item id, ``distance``) for each row of ``docs`` and item that occurs in it within the item's budget.

    Texts are compared normalised; the budget is ``error_rate`` of the item's normalised length, rounded down; distance
    is the least over all places. Null, empty and symbol-only texts match nothing, on either side. Repeated rows and
    repeated items give a result row each; ids may be null. Empty tables, on either side, give no rows; very long texts are
    searched whole; of places that tie the distance is the same. Other columns are not read, so no names clash. A map,
    without a shuffle.
    """
    picked = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    item_type = benchmark.schema[item_col].dataType
    schema = T.StructType([T.StructField(id_col, picked.schema["id"].dataType), T.StructField(item_col, item_type), T.StructField("distance", T.IntegerType())])
    arrow_item = pa.schema(_arrow(schema)).field(1).type

    def scan(name, shared):
        def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            match = _matcher(name, shared)
            for batch in rows:
                at, items, distances = [], [], []
                for i, text in enumerate(normalise(batch.column(1)).to_pylist()):
                    for item, distance in match.hits(text) if text else ():
                        at.append(i)
                        items.append(item)
                        distances.append(distance)
                ids = batch.column(0).take(pa.array(at, pa.int32()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(items, arrow_item), pa.array(distances, pa.int32())], names=schema.names)

        return batches

    out = None
    for name, shared in _passes(benchmark, item_col, item_text_col, error_rate, chars_a_pass):
        part = picked.mapInArrow(scan(name, shared), schema)
        out = part if out is None else out.unionByName(part)
    return out


def _arrow(schema: T.StructType) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(schema))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", chars_a_pass: int = CHARS_A_PASS,
) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item occurs (see ``contamination``). Null and empty texts stay, as does
    everything when there are no items; repeated rows stay or go together.
    """
    where = docs.columns.index(text_col)

    def clean(name, shared):
        def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            match = _matcher(name, shared)
            for batch in rows:
                texts = normalise(batch.column(where)).to_pylist()
                yield batch.filter(pa.array([not t or next(match.hits(t), None) is None for t in texts], pa.bool_()))

        return batches

    for name, shared in _passes(benchmark, item_col, item_text_col, error_rate, chars_a_pass):
        docs = docs.mapInArrow(clean(name, shared), docs.schema)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
