"""HTML extraction by minimum cut: which blocks of a page are content, decided together.

A page is a sequence of text blocks. A logistic classifier, trained here on blocks that semantic tags label, prices each
block's two labels: these prices are the capacities of edges from the source (content) and to the sink (boilerplate).
Edges between neighbours in reading order and between blocks near each other in the DOM charge for a change of label.
The minimum cut, by Dinic's maximum flow, is the cheapest labelling of the whole page.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, table

#: Pages whose labelled blocks train the classifier: the bound of the one model that is fitted on a sample.
TRAINING_PAGES = 1_000
#: Capacities are whole numbers: cost times this.
UNIT = 1000
#: Cost of a change of label between neighbours, and between blocks of one DOM parent; both fade with DOM distance.
ADJACENT, SIBLING = 0.8, 0.6
#: Added to the classifier's score inside tags that say what they hold.
SEMANTIC = 1.5

_TOKEN = re.compile(r"(?is)<!--.*?-->|<(script|style|noscript|template|svg|iframe|select|textarea)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-z][a-z0-9]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>")
_BLOCKS = frozenset("p li ul ol dl dt dd div nav article section main header footer aside h1 h2 h3 h4 h5 h6 br hr tr td th table thead tbody title head body html blockquote pre form figure figcaption address details summary".split())
_VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
_CONTENT, _CHROME = frozenset(("article", "main")), frozenset(("nav", "footer", "aside", "header", "form", "menu"))
_CHROME_NAME = re.compile(r"(?i)(?:class|id)\s*=\s*[\"']?[^\"'>]*\b(?:ads?|advert\w*|banner|sidebar|menu|nav\w*|footer|cookie\w*|share|social|promo\w*|related|comments?)\b")
_SPACE = re.compile(r"\s+")
FEATURES = 8
#: Elements whose end tag may be left out: the open ones that a start tag ends, and what they are looked for within.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th")}
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "tbody": ("table",), "p": ("table", "td", "th", "button", "object")}
_IN_HEAD = frozenset("html head title base link meta style script noscript template".split())
#: Start tags that end an open paragraph.
_ENDS_P = _BLOCKS - frozenset("br tr td th thead tbody title head body html".split()) | {"menu"}


class Block:
    __slots__ = ("hint", "link_chars", "parent", "depth", "tag", "text")

    def __init__(self, text: str, link_chars: int, tag: str, parent: int, depth: int, hint: int):
        self.text, self.link_chars, self.tag, self.parent, self.depth, self.hint = text, link_chars, tag, parent, depth, hint


def blocks(page: str) -> list[Block]:
    """Text blocks in reading order. Malformed markup never fails: stray end tags are ignored, open ones end with the page."""
    found: list[Block] = []
    stack: list[tuple[str, int, int]] = []  # tag, node number, hint
    text: list[str] = []
    linked = link_depth = nodes = at = 0
    places: dict[str, list[int]] = {}  # where each tag is open on the stack

    def pop_to(n: int) -> None:
        while len(stack) > n:
            places[stack.pop()[0]].pop()

    def last(tag: str) -> int:
        return places[tag][-1] if places.get(tag) else -1

    def close(tags: tuple[str, ...], scope: tuple[str, ...]) -> None:
        floor = max(map(last, scope))
        while open_at := [i for i in map(last, tags) if i > floor]:
            pop_to(min(open_at))

    def flush() -> None:
        nonlocal linked
        joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
        if joined and not places.get("title") and not places.get("head"):
            tag, parent, depth, hint = "", 0, 0, 0
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in _BLOCKS:
                    tag, depth, parent = stack[i][0], i, stack[i - 1][1] if i else 0
                    break
            if stack:
                hint = stack[-1][2]
            found.append(Block(joined, min(linked, len(joined)), tag, parent, depth, hint))
        text.clear()
        linked = 0

    for m in _TOKEN.finditer(page):
        chunk = page[at : m.start()]
        at = m.end()
        if chunk:
            text.append(chunk)
            if link_depth:
                linked += len(chunk)
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _BLOCKS:
            flush()
        if m.group(2):
            if last(tag) > max(map(last, _SCOPE.get(tag, ())), default=-1):
                pop_to(last(tag))
            if tag == "a" and link_depth:
                link_depth -= 1
            continue
        if tag not in _IN_HEAD and places.get("head"):
            pop_to(places["head"][0])
        if tag in _ENDS_P:
            close(("p",), _SCOPE["p"])
        if tag in _CLOSES:
            close(_CLOSES[tag], _SCOPE[tag])
        if tag not in _VOID and not m.group(4).endswith("/"):
            nodes += 1
            hint = stack[-1][2] if stack else 0
            if tag in _CHROME or (tag in _BLOCKS and _CHROME_NAME.search(m.group(4))):
                hint = -1
            elif tag in _CONTENT and hint == 0:
                hint = 1
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, nodes, hint))
            if tag == "a":
                link_depth += 1
    text.append(page[at:])
    flush()
    return found


def features(found: list[Block]) -> list[list[float]]:
    n, out = len(found), []
    for i, b in enumerate(found):
        words = b.text.count(" ") + 1
        size = len(b.text)
        stops = b.text.count(". ") + b.text.count(", ") + (b.text[-1] in ".!?…")
        near = (len(found[i - 1].text) if i else 0) + (len(found[i + 1].text) if i + 1 < n else 0)
        out.append([1.0, math.log1p(words), b.link_chars / size, min(1.0, stops / words * 5), math.log1p(near) / 5, float(b.tag in ("li", "td", "th")), float(b.tag in ("p", "blockquote", "pre")), float(b.tag in ("h1", "h2", "h3"))])
    return out


#: Where no page has semantic tags: long punctuated paragraphs without links are content.
DEFAULT_WEIGHTS = (-1.5, 0.6, -3.0, 1.0, 0.2, -0.8, 0.8, 0.5)


def train(rows: list[tuple[list[float], int]], steps: int = 30, ridge: float = 1.0) -> tuple[float, ...]:
    """Logistic regression by Newton steps; the default weights unless both labels are there."""
    y = np.array([label for _, label in rows], float)
    if len(rows) < 20 or y.min() == y.max():
        return DEFAULT_WEIGHTS
    x, w = np.array([f for f, _ in rows]), np.zeros(FEATURES)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(FEATURES), x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def min_cut(n: int, source: list[int], sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """True for the nodes on the source's side of a minimum cut (the smallest such side). ``edges`` go both ways."""
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[int] = []

    def add(a: int, b: int, there: int, back: int) -> None:
        head[a].append(len(to))
        to.append(b)
        room.append(there)
        head[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in range(n):
        both = min(source[i], sink[i])  # flows straight through
        if source[i] > both:
            add(s, i, source[i] - both, 0)
        elif sink[i] > both:
            add(i, t, sink[i] - both, 0)
    for a, b, c in edges:
        add(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in head[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        at = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                push = min(room[e] for e in path)
                cut = len(path)
                for k, e in enumerate(path):
                    room[e] -= push
                    room[e ^ 1] += push
                    if not room[e] and k < cut:
                        cut = k
                a = to[path[cut] ^ 1]
                del path[cut:]
            while at[a] < len(head[a]):
                e = head[a][at[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            if at[a] < len(head[a]):
                path.append(head[a][at[a]])
                a = to[path[-1]]
            elif path:
                level[a] = -1
                e = path.pop()
                a = to[e ^ 1]
            else:
                break


def capacities(found: list[Block], weights: tuple[float, ...]) -> tuple[list[int], list[int], list[tuple[int, int, int]]]:
    """Costs of calling each block boilerplate (source side) and content (sink side), and of separating pairs."""
    source, sink = [], []
    for b, f in zip(found, features(found), strict=True):
        score = sum(w * x for w, x in zip(weights, f, strict=True)) + SEMANTIC * b.hint
        score = max(-30.0, min(30.0, score))
        source.append(round(UNIT * math.log1p(math.exp(score))))  # -log P(boilerplate)
        sink.append(round(UNIT * math.log1p(math.exp(-score))))
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, round(UNIT * ADJACENT / (1 + abs(b.depth - found[i - 1].depth)))))
        if (before := last.get(b.parent)) is not None:
            edges.append((before, i, round(UNIT * SIBLING / (1 + abs(b.depth - found[before].depth)))))
        last[b.parent] = i
    return source, sink, edges


def extract(page: str, weights: tuple[float, ...]) -> tuple[str, int, int]:
    """(content, number of blocks, number kept)."""
    found = blocks(page)
    kept = [b.text for b, keep in zip(found, min_cut(len(found), *capacities(found, weights)), strict=True) if keep]
    return "\n".join(kept), len(found), len(kept)


def fit_classifier(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", training_pages: int = TRAINING_PAGES) -> tuple[float, ...]:
    """Weights from the blocks under content and chrome tags of the ``training_pages`` distinct pages with the least hash."""
    read = pages.select(col(html_col).cast("string").alias("html")).filter("html IS NOT NULL").withColumn("h", F.xxhash64("html"))
    # only hashes are sorted: the pages up to the last of the least ones are then read where they lie
    last = read.select("h").distinct().orderBy("h").limit(training_pages).agg(F.max("h")).first()[0]
    if last is None:
        return DEFAULT_WEIGHTS
    sample = read.filter(F.col("h") <= last).dropDuplicates(["h"]).select("html")
    schema = "f array<double>, y int"

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            fs, ys = [], []
            for page in batch.column(0).to_pylist():
                found = blocks(page)
                for b, f in zip(found, features(found), strict=True):
                    if b.hint:
                        fs.append(f)
                        ys.append(int(b.hint > 0))
            yield pa.RecordBatch.from_arrays([pa.array(fs, pa.list_(pa.float64())), pa.array(ys, pa.int32())], names=["f", "y"])

    return train([(r["f"], r["y"]) for r in sorted(sample.mapInArrow(batches, schema).collect())])


def extract_content(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", weights: tuple[float, ...] | None = None) -> DataFrame:
    """Per page: id, ``text`` (content blocks joined by newlines), ``n_blocks``, ``n_kept``.

    Null HTML gives a null text and no blocks; empty or tag-only HTML an empty text. Of equally cheap labellings the
    one with the fewest content blocks holds. Repeated rows give a row each; ids may be null; an empty table gives an empty
    one; very long pages are cut as one graph. Other columns are not read, so no names clash. A map, without a shuffle,
    after the classifier's sample.
    """
    weights = fit_classifier(pages, id_col, html_col) if weights is None else weights
    picked = pages.select(col(id_col).alias("id"), col(html_col).cast("string").alias("html"))
    schema = T.StructType([T.StructField(id_col, picked.schema["id"].dataType), T.StructField("text", T.StringType()), T.StructField("n_blocks", T.IntegerType()), T.StructField("n_kept", T.IntegerType())])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            done = [(None, 0, 0) if p is None else extract(p, weights) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int32()), pa.array([d[2] for d in done], pa.int32())], names=schema.names)

    return picked.mapInArrow(batches, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_content(table(spark, sf_dir, "pages"))
