"""Secret scan: how many guesses would a value in a credential's place cost?

One regular expression, run inside the JVM, finds values in a credential context (``password=...``, ``apiToken: "..."``,
key identifiers of cloud providers). Only those values reach Python, where dynamic programming finds the cheapest
segmentation into dictionary words, dates, repeats, keyboard walks, sequences and brute-force spans. A value whose
cheapest description still costs many guesses is a generated secret; ``changeme2024`` is not.
"""

from __future__ import annotations

import base64
import math
import re
import uuid
from collections import deque
from collections.abc import Iterator, Sequence
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, table

_KEY = r"pass(?:word|wd|phrase)?|pwd|secret(?:[_-]?key)?|token|api[_-]?key|access[_-]?key|auth[_-]?key|client[_-]?secret|private[_-]?key|credentials?"
#: A context's name: at the start of a word or of a camel-case part, with a suffix such as ``_prod``, ``2`` or ``Old``.
_NAME = rf"(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))(?i:{_KEY})(?:[_-][A-Za-z0-9_-]*|[0-9]+|[A-Z][A-Za-z0-9_-]*)?"
#: The same expression in Java and Python: name, separator, a quoted value or all up to white space; or a key that names itself.
CONTEXT = rf"""{_NAME}["']?[ \t]*+(?:=>|:=|=|:)[ \t]*+(?:"(?:[^"\\\n]|\\.)+"|'(?:[^'\\\n]|\\.)+'|\S+)|\b(?:AKIA|ASIA)[A-Z0-9]{{16}}\b|\bgh[pousr]_[A-Za-z0-9]{{20,}}"""
_PARTS = re.compile(rf"""(?s)^((?i:{_KEY}))[A-Za-z0-9_-]*["']?[ \t]*(?:=>|:=|=|:)[ \t]*(.+)$""")

#: Common password words by rank; ``load_words`` gives longer lists.
WORDS = """password 123456 qwerty admin letmein welcome monkey dragon master login abc123 football iloveyou princess sunshine
shadow superman michael jordan hunter baseball batman trustno1 thomas robert access love secret summer winter spring autumn
hello freedom whatever charlie jessica pepper daniel ashley buster soccer hockey george andrew harley ranger jennifer joshua
maggie starwars silver william dallas yankees ginger hammer computer amanda cookie purple orange banana killer pokemon
test guest user root default changeme example sample demo temp public private token api key pass word server database
system service account client backup oracle mysql postgres redis docker linux windows ubuntu apple google amazon azure
cloud prod production staging develop debug dev null none true false todo fixme xxxx your here insert value string
placeholder dummy foobar foo bar baz qux the and for you that with this from have not are was his her they
one all can had but what out were there when use how said each which she will about many then them some
time make like him into has look two more write see number way could people than first water been call who oil
now find long down day did get come made may part over new sound take only little work know place year live
house money music happy lucky forever flower angel baby girl boy king queen tiger lion eagle wolf bear horse dog cat
fish bird star moon sun sky fire ice stone gold red blue green black white brown yellow pink
january february march april june july august september october november december monday tuesday wednesday thursday friday
saturday sunday hola amor casa gato perro amigo familia contrasena passwort geheim hallo liebe schatz bonjour soleil
motdepasse azerty doudou chocolat merci monde""".split()
_LEET = str.maketrans("@4301!5$7", "aaeolisst")
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_SHIFTED = str.maketrans('~!@#$%^&*()_+{}|:"<>?', r"`1234567890-=[]\;',./")
BRUTE = math.log2(10)
#: Cost of saying that another segment follows.
SEGMENT = 2.0
WALK_START, WALK_STEP = math.log2(47), math.log2(4.6)
#: A generated secret costs at least 10^10 guesses.
SECRET_BITS = 10 * math.log2(10)
#: The year that dates are counted from.
THIS_YEAR = 2025
_CLOSERS = {")": "(", "]": "[", "}": "{", ">": "<", '"': '"', "'": "'"}


def _neighbours() -> dict[str, set[str]]:
    near: dict[str, set[str]] = {}
    for y, row in enumerate(_ROWS):
        for x, c in enumerate(row):
            near[c] = {_ROWS[v][u] for v, u in ((y, x - 1), (y, x + 1), (y - 1, x), (y - 1, x + 1), (y + 1, x), (y + 1, x - 1)) if 0 <= v < 4 and 0 <= u < len(_ROWS[v])}
    return near


_NEAR = _neighbours()
_DATE = re.compile(r"(?=((?:19|20)[0-9]{2}[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:19|20)[0-9]{2}))")
_YEAR = re.compile(r"(?=((?:19|20)[0-9]{2}))")


def load_words(path: str) -> list[str]:
    """Words by rank from a file: one a line (what follows white space is ignored), or the words of a ``.tiktoken``
    vocabulary, whose merges are ranked by frequency. A file without words, or a line of a vocabulary that is not base64,
    is an error: a shorter dictionary would raise ``guess_bits`` and look like a result.
    """
    with Path(path).open("rb") as lines:
        if path.endswith(".tiktoken"):
            pieces = (base64.b64decode(line.split()[0], validate=True).decode("utf-8", "ignore") for line in lines)
            found = (p[1:].lower() for p in pieces if p.startswith(" ") and p[1:].isalpha())
        else:
            found = (line.decode("utf-8", "ignore").split()[0].lower() for line in lines if line.strip())
        words = list(dict.fromkeys(w for w in found if len(w) >= 3))
    if not words:
        raise ValueError(f"no words of three letters or more in {path}")
    return words


def automaton(words: Sequence[str] = WORDS) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for rank, word in reversed(list(enumerate(words, 1))):
        if len(word) >= 3:
            found.add_word(word, (len(word), math.log2(rank + 1)))
    found.make_automaton()
    return found


_WORDS = automaton()


def _lower(value: str) -> str:
    lower = value.lower()
    return lower if len(lower) == len(value) else "".join(c.lower() if len(c.lower()) == 1 else c for c in value)  # a few letters change length


def matches(value: str, words: ahocorasick.Automaton = _WORDS, this_year: int = THIS_YEAR) -> list[tuple[int, int, float, str]]:
    """(start, end, bits, kind) of every word, date and ASCII sequence in ``value``."""
    found: list[tuple[int, int, float, str]] = []
    lower = _lower(value)
    for text, extra in ((lower, 0.0), (lower.translate(_LEET), 1.0)):
        if extra and text == lower:
            continue
        for end, (n, bits) in words.iter(text):
            a, b = end + 1 - n, end + 1
            found.append((a, b, bits + extra + (0.0 if value[a:b] == lower[a:b] else 1.0), "word"))
    for m in _DATE.finditer(value):
        text = m.group(1)
        year = int(text[:4]) if _YEAR.match(text) else int(text[-4:])
        found.append((m.start(), m.start() + len(text), math.log2(365 * max(20, abs(year - this_year))) + (2.0 if not text.isdigit() else 0.0), "date"))
    found += [(m.start(), m.start() + 4, math.log2(max(20, abs(int(m.group(1)) - this_year))), "date") for m in _YEAR.finditer(value)]
    for step in (1, -1):
        start = 0
        for i in range(1, len(value) + 1):
            if i < len(value) and value[i].isascii() and value[i].isalnum() and value[i - 1].isalnum() and ord(value[i]) - ord(value[i - 1]) == step:
                # at most 26 letters or 10 digits follow one another, so all spans that end here are few
                found += [(a, i + 1, math.log2(26) + math.log2(i + 1 - a), "sequence") for a in range(start, i - 1)]
            else:
                start = i
    return found


def repetitions(value: str) -> list[tuple[int, int, int]]:
    """(start, end, period) of every maximal span of two or more copies of a shortest unit. n log n comparisons.

    A repetition of period p covers a multiple of p whose character equals the one p further on, or the one before does;
    from there it is followed to both sides, over p characters at most, by the halves of a polynomial hash.
    """
    n = len(value)
    if n < 2:
        return []
    codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    period = np.repeat(np.arange(1, n // 2 + 1), [len(range(0, n - p, p)) for p in range(1, n // 2 + 1)])
    first = np.concatenate([np.arange(0, n - p, p) for p in range(1, n // 2 + 1)])
    some = codes[first] == codes[first + period]
    some |= (first > 0) & (codes[first - 1] == codes[first + period - 1])
    first, period = first[some], period[some]
    sums, powers = [], []
    for base, prime in ((911382323, 2147483647), (972663749, 2147483629)):
        h, p = [0], [1]
        for c in codes.tolist():
            h.append((h[-1] * base + c + 1) % prime)
            p.append(p[-1] * base % prime)
        sums.append((np.array(h), prime))
        powers.append(np.array(p))

    def same(a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        ok = np.ones(len(a), bool)
        for (h, prime), p in zip(sums, powers, strict=True):
            ok &= (h[a + length] - h[a] * p[length] - h[b + length] + h[b] * p[length]) % prime == 0
        return ok

    def reach(most: np.ndarray, at) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.copy()
        while (open_ := low < high).any():
            mid = np.where(open_, (low + high + 1) // 2, low)
            ok = same(*at(mid), mid)
            low, high = np.where(open_ & ok, mid, low), np.where(open_ & ~ok, mid - 1, high)
        return low

    after = reach(np.minimum(period, n - first - period), lambda m: (first, first + period))
    before = reach(np.minimum(period, first), lambda m: (first - m, first + period - m))
    whole = after + before >= period
    spans: dict[int, list[list[int]]] = {}
    for p, a, b in zip(period[whole].tolist(), (first - before)[whole].tolist(), (first + after + period)[whole].tolist(), strict=True):
        known = spans.setdefault(p, [])
        if known and a <= known[-1][1] - p:
            known[-1][1] = max(known[-1][1], b)
        else:
            known.append([a, b])
    found: list[tuple[int, int, int]] = []
    seen: set[tuple[int, int]] = set()
    for p in sorted(spans):
        for a, b in spans[p]:
            if (a, b) not in seen:  # else a multiple of a shorter period
                seen.add((a, b))
                found.append((a, b, p))
    return found


class _Repeats:
    """Cheapest repeat that ends at a place inside one repetition: minima over windows of starts, one per power of two of
    the count. Every start is pushed and popped once a window.
    """

    def __init__(self, start: int, end: int, period: int):
        self.start, self.end, self.period = start, end, period
        self.windows: dict[tuple[int, int], deque] = {}

    def least(self, j: int, opened: list[float]) -> tuple[float, int]:
        a, p = self.start, self.period
        at, rest = divmod(j - a, p)
        best, best_from = math.inf, j
        power = 1
        while 1 << power <= at:
            low, new = at - (1 << (power + 1)) + 1, at - (1 << power)
            window = self.windows.setdefault((rest, power), deque())
            cost = opened[a + rest + new * p]
            while window and window[-1][1] >= cost:
                window.pop()
            window.append((new, cost))
            while window[0][0] < low:
                window.popleft()
            cost = window[0][1] + BRUTE * p + power + 1
            if cost < best:
                best, best_from = cost, a + rest + window[0][0] * p
            power += 1
        return best, best_from


def guess_bits(value: str, words: ahocorasick.Automaton = _WORDS, this_year: int = THIS_YEAR) -> tuple[float, str]:
    """Least log2 guesses over all segmentations, and the kinds of its segments.

    Segments: a word costs log2 of its rank + 1, one more in leet letters and one more with capitals; a date log2 of its
    days in the years since, two more with separators; k copies of a unit of u characters u log2(10) and the bits of k;
    a keyboard walk of three or more keys log2(47) and log2(4.6) a step; an ascending or descending ASCII sequence of
    three or more log2(26 n); anything else log2(10) a character. A segment after the first costs ``SEGMENT`` more. Every
    part of a walk, a sequence or a repetition is a segment too. Ties prefer the order word, date, sequence, repeat, walk,
    brute force, and the earlier match.
    """
    n = len(value)
    ending: dict[int, list[tuple[int, float, str]]] = {}
    for a, b, bits, kind in matches(value, words, this_year):
        ending.setdefault(b, []).append((a, bits, kind))
    starting: dict[int, list[_Repeats]] = {}
    for a, b, p in repetitions(value):
        starting.setdefault(a + 2 * p, []).append(_Repeats(a, b, p))
    keys = _lower(value).translate(_SHIFTED)
    best, opened, back = [0.0] * (n + 1), [0.0] * (n + 1), [(0, "")] * (n + 1)
    brute, brute_from = math.inf, 0
    walk, walk_from, walk_start = math.inf, 0, 0
    live: list[_Repeats] = []
    for j in range(1, n + 1):
        if opened[j - 1] < brute:
            brute, brute_from = opened[j - 1], j - 1
        brute += BRUTE
        least, whence = math.inf, (brute_from, "brute")
        for a, bits, kind in ending.get(j, ()):
            if opened[a] + bits < least:
                least, whence = opened[a] + bits, (a, kind)
        live = [r for r in live if r.end >= j] + starting.get(j, [])
        for r in live:
            cost, a = r.least(j, opened)
            if cost < least:
                least, whence = cost, (a, "repeat")
        if j > 1 and keys[j - 1] not in _NEAR.get(keys[j - 2], ()):
            walk, walk_start = math.inf, j - 1
        if j - walk_start >= 3:
            if opened[j - 3] - WALK_STEP * (j - 3) < walk:
                walk, walk_from = opened[j - 3] - WALK_STEP * (j - 3), j - 3
            if walk + WALK_START + WALK_STEP * (j - 1) < least:
                least, whence = walk + WALK_START + WALK_STEP * (j - 1), (walk_from, "walk")
        if brute < least:
            least, whence = brute, (brute_from, "brute")
        best[j], back[j] = least, whence
        opened[j] = least + SEGMENT
    kinds, j = [], n
    while j > 0:
        j, kind = back[j]
        kinds.append(kind)
    return best[n], "+".join(reversed(kinds))


def split_context(text: str) -> tuple[str, str, str]:
    """(context, value, trimmed) of what ``CONTEXT`` matched.

    A quoted value is what the quotes hold. A bare one is all up to white space, and ``trimmed`` is it without closing
    brackets, quotes and tags' ends that it does not open, and without a sentence mark at its end.
    """
    m = _PARTS.match(text)
    if not m:
        return ("aws_key_id" if text[1:4] in ("KIA", "SIA") else "github_token"), text, text
    value = m.group(2)
    if len(value) > 2 and value[0] in "\"'" and value[-1] == value[0]:
        return m.group(1).lower(), value[1:-1], value[1:-1]
    end, counts = len(value), {}
    for c in value:
        counts[c] = counts.get(c, 0) + 1
    marks = 1
    while end > 1:
        last = value[end - 1]
        if last in _CLOSERS and (counts[last] % 2 if last in "\"'" else counts[last] > counts.get(_CLOSERS[last], 0)):
            counts[last] -= 1
        elif last in ".,;:!?" and marks:
            marks = 0
        else:
            break
        end -= 1
    return m.group(1).lower(), value, value[:end]


_automata: dict[str, ahocorasick.Automaton] = {}


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", secret_bits: float = SECRET_BITS, words: Sequence[str] = WORDS, this_year: int = THIS_YEAR
) -> DataFrame:
    """A row for every value in a credential context: id, ``occurrence`` (its number in the text, from 0), ``context``,
    ``value``, ``trimmed`` (``split_context``), ``guess_bits`` (of the dearer of both, rounded to 6 places), ``segments``
    of that one, ``is_secret`` (``guess_bits`` >= ``secret_bits``).

    Null and empty texts, and an empty table, give no rows. Repeated rows and repeated values give a row each; ids may be
    null. Texts and values of any length are used whole: a value of n characters takes n log n steps and room. Ties
    between segmentations don't change ``guess_bits``; ``segments`` follows the order in ``guess_bits()``. Other columns
    are not read, so their names cannot clash. ``words``: the dictionary by rank. A map, without a shuffle.
    """
    hit = F.regexp_extract_all(col(text_col).cast("string"), F.lit(CONTEXT), F.lit(0))
    picked = docs.select(col(id_col).alias("id"), F.posexplode(hit).alias("occurrence", "hit"))
    schema = T.StructType([
        T.StructField(id_col, picked.schema["id"].dataType), T.StructField("occurrence", T.IntegerType()), T.StructField("context", T.StringType()), T.StructField("value", T.StringType()),
        T.StructField("trimmed", T.StringType()), T.StructField("guess_bits", T.DoubleType()), T.StructField("segments", T.StringType()), T.StructField("is_secret", T.BooleanType()),
    ])
    shared, key = docs.sparkSession.sparkContext.broadcast(list(words)), uuid.uuid4().hex

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _automata:
            _automata.clear()
            _automata[key] = automaton(shared.value)
        known = _automata[key]
        for batch in rows:
            parts = [split_context(t) for t in batch.column(2).to_pylist()]
            costs = [max((guess_bits(v, known, this_year) for v in dict.fromkeys(p[1:])), key=lambda c: c[0]) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array([p[i] for p in parts], pa.string()) for i in range(3)],
                 pa.array([round(b, 6) for b, _ in costs], pa.float64()), pa.array([s for _, s in costs], pa.string()), pa.array([b >= secret_bits for b, _ in costs], pa.bool_())],
                names=schema.names,
            )

    return picked.mapInArrow(batches, schema)


def public_words() -> list[str]:
    """The built-in list, then the words of the public tokenizer vocabulary on this machine. Without one there is no result:
    the built-in list alone gives other prices for the same values.
    """
    from importlib.util import find_spec

    if find_spec("public_tokenizers") is None:
        raise FileNotFoundError("no vocabulary: give scan_secrets words, load_words of a file or the built-in WORDS")
    import public_tokenizers

    return list(dict.fromkeys([*WORDS, *load_words(public_tokenizers.path("byte_bpe_50k.tiktoken"))]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"), words=public_words())
