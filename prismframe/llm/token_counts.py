"""Token counts without tokens: Viterbi over a unigram vocabulary that keeps only a score and a piece count.

An Aho-Corasick automaton enumerates every vocabulary piece inside a word; dynamic programming over character
positions carries the best score and the number of pieces on the best path. Ties go, as in the tokenizer, to the piece
that starts first (candidates replace the incumbent only when strictly better). No piece of such a vocabulary crosses
from a letter into a following word mark, so a text's best path is the concatenation of its words' best paths: words
are solved once per worker and looked up afterwards, which makes the cost that of splitting the text.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from pathlib import Path

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import col, table

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words remembered per worker; beyond it the memory is emptied, which changes the time taken and nothing else.
REMEMBERED_WORDS = 800_000


def default_model() -> str:
    """The public piece vocabulary on this machine. It is a BPE model: its scores are ranks of merges, read here as those of
    a unigram vocabulary, since no public tokenizer at hand is of that kind.
    """
    from importlib.util import find_spec

    if find_spec("public_tokenizers") is None:
        raise FileNotFoundError("no vocabulary: give model_path, a sentencepiece file")
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_vocabulary(path: str | None = None) -> dict:
    """Pieces and scores of a sentencepiece file. Control, unknown and byte pieces match no text."""
    from sentencepiece import SentencePieceProcessor

    path = path or default_model()
    if not Path(path).exists():
        raise FileNotFoundError(path)
    model = SentencePieceProcessor(model_file=path)
    pieces, scores, has_bytes = [], [], False
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            has_bytes = True
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces.append(model.id_to_piece(i))
            scores.append(float(model.get_score(i)))
    return {"pieces": pieces, "scores": scores, "byte_fallback": has_bytes}


class CountOnlyViterbi:
    """Counts the pieces of the best segmentation. ``vocabulary``: pieces, scores, byte_fallback."""

    def __init__(self, vocabulary: dict, dummy_prefix: bool = True):
        self.automaton = ahocorasick.Automaton()
        for piece, score in zip(vocabulary["pieces"], vocabulary["scores"], strict=True):
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.singles = frozenset(p for p in vocabulary["pieces"] if len(p) == 1)
        self.unknown = min(vocabulary["scores"], default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback, self.dummy_prefix = vocabulary["byte_fallback"], dummy_prefix
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in vocabulary["pieces"])
        lines = not any("\n" in p for p in vocabulary["pieces"]) and self.byte_fallback
        if crossing or not self.byte_fallback:  # unknown runs merge across words: then a text is one word
            self.words = re.compile(r"(?s).+").findall
        else:
            self.words = re.compile(rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+" if lines else rf"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.known: dict[str, int] = {}

    def best(self, word: str) -> tuple[float, int]:
        """Score and number of pieces of the best path through ``word``."""
        n = len(word)
        if self.singles.issuperset(word):  # every position can be reached, so unknown characters never come in
            score, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
            for end, (length, gain) in self.automaton.iter(word):
                start, end = end + 1 - length, end + 1
                candidate = score[start] + gain
                if candidate > score[end]:
                    score[end], count[end] = candidate, count[start] + 1
            return score[n], count[n]
        score, count, unknown_end = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches = self.automaton.iter(word)
        upcoming = next(matches, None)
        for at in range(n):
            top, pieces, single, unknown = None, 0, False, False
            while upcoming is not None and upcoming[0] == at:  # longest first, so the earliest start first
                length, gain = upcoming[1]
                candidate = score[at + 1 - length] + gain
                if top is None or candidate > top:
                    top, pieces = candidate, count[at + 1 - length] + 1
                single |= length == 1
                upcoming = next(matches, None)
            if not single:
                candidate = score[at] + self.unknown
                if top is None or candidate > top:
                    cost = len(word[at].encode("utf-8", "surrogatepass")) if self.byte_fallback else int(not unknown_end[at])
                    top, pieces, unknown = candidate, count[at] + cost, True
            score[at + 1], count[at + 1], unknown_end[at + 1] = top, pieces, unknown
        return score[n], count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for word in self.words((MARK if self.dummy_prefix else "") + text.replace(" ", MARK)):
            found = known.get(word)
            if found is None:
                found = self.best(word)[1]
                if len(known) >= REMEMBERED_WORDS:
                    known.clear()
                if len(word) <= 256:
                    known[word] = found
            total += found
        return total


_counters: dict[str, CountOnlyViterbi] = {}


def token_counts(
    docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", dummy_prefix: bool = True
) -> DataFrame:
    """One row per input row: ``id_col`` and ``n_tokens`` (BIGINT).

    A null text counts as null, an empty one as 0; an empty table gives an empty one. Repeated rows are counted each; a null
    id stays null; other columns are never read, so their names cannot clash. Very long texts are counted whole, word by
    word. Ties go to the piece that starts first. Texts are not normalised (no NFKC, no collapsing of spaces). No shuffle: a
    map over the two columns, linear in the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model_path))
    picked = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField(id_col, picked.schema["id"].dataType), T.StructField("n_tokens", T.LongType())])
    key = uuid.uuid4().hex

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _counters:
            _counters.clear()
            _counters[key] = CountOnlyViterbi(shared.value, dummy_prefix)
        count = _counters[key].count
        for batch in rows:
            counts = [None if t is None else count(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=[id_col, "n_tokens"])

    return picked.mapInArrow(batches, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
