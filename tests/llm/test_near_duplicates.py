import random

import numpy as np
import pyarrow as pa

from prismframe.llm import near_duplicates as N
from prismframe.llm.near_duplicates import THRESHOLD, drop_near_duplicates, gram_sets, linked_documents, near_duplicate_groups, part_keys, query, similar_pairs, verified_pairs

WORDS = [f"w{i}" for i in range(3000)]


def corpus(seed=1, n=150):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        base = [rng.choice(WORDS) for _ in range(rng.choice([1, 2, 3, 8, 30, 90, 300, 900]))]
        texts.append(base)
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            copy = list(base)
            for _ in range(int(len(copy) * rng.choice([0, 0.02, 0.05, 0.1, 0.3]))):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(copy)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def brute_pairs(rows, t=THRESHOLD):
    sets = [set(g.tolist()) for g in gram_sets(pa.array([x for _, x in rows]), 2)]
    out = set()
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= t:
                out.add((rows[j][0], rows[i][0]))
    return out


def closure(pairs):
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in pairs:
        top[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in top}


def brute_links(rows, t=THRESHOLD):
    """{(id, class, copies, links)} from all pairs of distinct sets."""
    by_set = {}
    for (i, _), g in zip(rows, gram_sets(pa.array([x for _, x in rows]), 2), strict=True):
        if len(g):
            by_set.setdefault(frozenset(g.tolist()), []).append(i)
    links = {s: sum(s is not o and len(s & o) / len(s | o) >= t for o in by_set) for s in by_set}
    return {(i, min(ids), len(ids) - 1, links[s]) for s, ids in by_set.items() for i in ids if len(ids) > 1 or links[s]}


def links(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_groups_against_brute_force(spark):
    rows = corpus()
    want = brute_pairs(rows)
    got = {r.doc_id: r.group_id for r in near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) > 100 and got == closure(want)


def test_class_pairs_and_membership(spark):
    rows = corpus(7, 60)
    equal, similar = verified_pairs(spark.createDataFrame(rows, "id long, text string"))
    classes = {(c, i) for i, c, _, _ in brute_links(rows) if c != i}
    first = {i: c for c, i in classes}
    assert {(r.a, r.b) for r in equal.collect()} == classes
    assert {tuple(sorted((r.a, r.b))) for r in similar.collect()} == {(a, b) for a, b in brute_pairs(rows) if a not in first and b not in first}


def test_links_against_brute_force(spark):
    rows = corpus(5, 120) + [(10_000 + i, x) for i, x in corpus(5, 20)]
    assert links(linked_documents(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_links(rows)


def test_hot_keys_and_tiles_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(N, "HOT_ROWS", 3)
    monkeypatch.setattr(N, "TILE_PAIRS", 5)
    monkeypatch.setattr(N, "HELD", 50)
    rows = corpus(11, 60)
    passage = [f"p{i}" for i in range(61)]
    rows += [(5000 + i, " ".join(passage + [f"own{i}x{j}" for j in range(20)])) for i in range(40)]
    keys = np.arange(1, 9).astype(np.uint64) << np.uint64(40)
    at, _ = N._tiles(keys, 77, np.array([1, 2, 3, 4, 9, 100, 127, 255], np.uint8))
    assert (np.bincount(at)[:6] == [1, 1, 1, 2, 3, 34]).all()
    for i in range(30):  # every two documents share a tile
        for j in range(i):
            assert set(N._tiles(keys[5:6], 3**i, np.array([30], np.uint8))[1].tolist()) & set(N._tiles(keys[5:6], 5**j, np.array([30], np.uint8))[1].tolist())
    # in this process, as workers don't see monkeypatched constants of the driver's module
    counters = np.full(N.COUNTERS, 9, np.uint8)
    columns = [np.concatenate(c) for c in zip(*[N.key_rows(g, N._node(g), THRESHOLD, counters) for g in gram_sets(pa.array([x for _, x in rows]), 2)], strict=True)]
    order = np.argsort(columns[0], kind="stable")
    columns = [c[order] for c in columns]
    again = N.unpack(memoryview(N.pack(columns)), len(order))
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(columns, again, strict=True))
    met = {(a, b) for batch in N._met(again, THRESHOLD) for a, b in zip(*[c.to_pylist() for c in batch.columns], strict=True)}
    nodes = {i: N._node(g) for (i, _), g in zip(rows, gram_sets(pa.array([x for _, x in rows]), 2), strict=True)}
    assert {tuple(sorted((nodes[a], nodes[b]))) for a, b in brute_pairs(rows) if nodes[a] != nodes[b]} <= met


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(3)
    for size in (1, 5, 16, 17, 300, 2000):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        for change in (0, 1, size // 3, size):
            b = np.unique(np.concatenate([a[: len(a) - change // 2], rng.integers(0, 1 << 63, change).astype(np.uint64)]))
            if len(b):
                assert N.hamming(N.sketch(a), N.sketch(b)) <= len(np.setxor1d(a, b))
    unrelated = [N.sketch(np.unique(rng.integers(0, 1 << 63, 1000).astype(np.uint64))) for _ in range(2)]
    assert N.hamming(*unrelated) > 0.5 * 1000


def test_codes_keep_the_order():
    counts = np.concatenate([np.arange(0, 1000), 10 ** np.arange(4, 9)]).astype(np.uint32)
    codes = N.coded(counts)
    assert (np.diff(codes.astype(int)) >= 0).all() and (codes[:128] == counts[:128]).all() and (N.decoded(codes)[:-2] >= counts[:-2] * 0.9).all()


def test_small_sets_always_share_a_part():
    rng = np.random.default_rng(0)
    for size in (1, 2, 5, 12, 40):
        for _ in range(200):
            a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            b = a.copy()
            for _ in range(size):
                c = b.copy()
                c[rng.integers(0, len(c))] = rng.integers(0, 1 << 63)
                c = np.unique(c)
                both = len(np.intersect1d(a, c))
                if both / (len(a) + len(c) - both) < THRESHOLD:
                    break
                b = c
            assert set(part_keys(a, THRESHOLD).tolist()) & set(part_keys(b, THRESHOLD).tolist())


def test_edges(spark):
    long = " ".join(f"v{i}" for i in range(60000))
    rows = [(1, "a b c", "g"), (2, "A, b c!", "g"), (2, "A, b c!", "g"), (3, None, "g"), (None, "a b c", "g"), (4, "", "g"), (5, "***", "g"), (6, long, "g"), (7, long + " end", "g"), (8, "solo", "g"), (9, "Solo", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, group_id string")
    groups = {(r.doc_id, r.group_id) for r in near_duplicate_groups(df).collect()}
    assert groups == {(1, 1), (2, 1), (6, 6), (7, 6), (8, 8), (9, 8)}
    assert links(linked_documents(df)) == {(1, 1, 1, 0), (2, 1, 1, 0), (6, 6, 0, 1), (7, 7, 0, 1), (8, 8, 1, 0), (9, 8, 1, 0)}
    assert linked_documents(df.filter("false")).count() == 0
    kept = sorted(((-1 if r.doc_id is None else r.doc_id), r.group_id) for r in drop_near_duplicates(df).collect())
    assert kept == [(-1, "g"), (1, "g"), (3, "g"), (4, "g"), (5, "g"), (6, "g"), (8, "g")]
    assert drop_near_duplicates(df.filter("false")).count() == 0


def test_repeated_rows_stay_once(spark):
    df = spark.createDataFrame([(1, "one two three"), (1, "one two three"), (2, "x"), (3, None), (3, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in drop_near_duplicates(df).collect()) == [1, 2, 3]


def test_all_pairs_of_a_shared_passage(spark):
    passage = [f"p{i}" for i in range(61)]
    rows = [(i, " ".join(passage + [f"own{i}x{j}" for j in range(20 if i % 2 else 21)])) for i in range(40)]  # 80 and 81 grams, 60 of them shared: 0.6 for two of 80, below it for others
    rows += [(100 + i, f"w{i} x y z") for i in range(8)] + [(200, "w1 x y z"), (201, rows[1][1])]
    got = {(r.a, r.b): r.jaccard for r in similar_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == brute_pairs(rows)
    assert len(got) == 21 * 20 // 2 + 1 and got[1, 3] == 0.6 and got[1, 201] == got[101, 200] == 1.0


def test_pairs_against_brute_force(spark):
    rows = corpus(3, 120)
    got = similar_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len({(r.a, r.b) for r in got}) and {(r.a, r.b) for r in got} == brute_pairs(rows)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert links(query(spark, "/root/testdata/sf0.001")) == brute_links(rows)
