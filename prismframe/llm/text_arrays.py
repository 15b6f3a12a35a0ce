"""Whole Arrow batches of texts as numpy arrays: byte classes and word hashes without a Python loop over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Inverse of BASE modulo 2^64.
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 1), base, np.uint64))])[: n + 1]


def byte_sizes(texts: pa.Array) -> np.ndarray:
    """Bytes of each text; nulls have none."""
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)


class Texts:
    """``data``: the bytes of all texts, each followed by a space; text ``i`` is ``data[starts[i]:ends[i]]``."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if lower:
            texts = pc.utf8_lower(texts)
        joined = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())) if len(texts) else texts
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1] if len(texts) else np.zeros(1, np.int64)
        first, last = int(offsets[0]), int(offsets[-1])
        self.data = np.frombuffer(joined.buffers()[2], np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
        self.starts, self.ends = offsets[:-1] - first, offsets[1:] - first - 1

    def counts(self, table: np.ndarray) -> np.ndarray:
        """Per text, the sum of ``table[byte]``."""
        total = np.concatenate([[0], np.cumsum(table[self.data], dtype=np.int64)])
        return total[self.ends] - total[self.starts]

    def words(self, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word hashes in order, the first word's number of each text, and word lengths in bytes."""
        inside = is_word[self.data]
        edges = np.diff(inside.astype(np.int8), prepend=0)
        begin = np.flatnonzero(edges == 1)
        end = np.flatnonzero(edges == -1)  # every text ends in a space, which is no word character
        with np.errstate(over="ignore"):
            # blocks keep the powers short; a word's hash does not depend on where it stands
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(self.data))[: len(self.data)], dtype=np.uint64)])
            hashes = mix((sums[end] - sums[begin]) * _powers(UNBASE, len(self.data))[begin] + (end - begin).astype(np.uint64))
        return hashes, np.searchsorted(begin, np.append(self.starts, len(self.data))), end - begin


#: Letters, digits and every byte of a non-ASCII character.
WORD_BYTES = np.array([chr(i).isalnum() if i < 128 else True for i in range(256)])
