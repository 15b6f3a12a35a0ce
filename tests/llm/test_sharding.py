import bisect
import random
from collections import Counter

from pyspark.sql import functions as F

from prismframe.llm.sharding import Treap, pack_histogram, query, shard, shard_documents


def brute(sizes, capacity):
    """Best-fit-decreasing, item by item; remaining room of every shard."""
    room = []
    for s in sorted(sizes, reverse=True):
        fits = [r for r in room if r >= s]
        if fits and s <= capacity:
            room.remove(min(fits))
            room.append(min(fits) - s)
        else:
            room.append(capacity - s)
    return Counter(room)


def filled(sizes, capacity):
    plan = pack_histogram(list(Counter(sizes).items()), capacity)
    room, n = {}, Counter()
    for size, lo, hi, first, each in plan:
        for rank in range(lo, hi):
            room[first + (rank - lo) // each] = room.get(first + (rank - lo) // each, capacity) - size
        n[size] += hi - lo
    assert n == Counter(sizes) and sorted(room) == list(range(len(room)))
    return Counter(room.values())


def test_histogram_packing_is_best_fit_decreasing():
    rng = random.Random(8)
    for _ in range(300):
        capacity = rng.randint(1, 40)
        sizes = [rng.randint(0, capacity + 3) for _ in range(rng.randint(0, 80))]
        assert filled(sizes, capacity) == brute(sizes, capacity)


def test_treap():
    rng, tree, keys = random.Random(1), Treap(), []
    for _ in range(2000):
        k = rng.randint(0, 300)
        if k in keys and rng.random() < 0.6:
            tree.remove(k)
            keys.remove(k)
        elif k not in keys:
            tree.insert(k)
            bisect.insort(keys, k)
        b = rng.randint(0, 310)
        at = bisect.bisect_left(keys, b)
        assert tree.ceiling(b) == (keys[at] if at < len(keys) else None)


def test_groups_share_shards_and_capacity_holds(spark):
    rng = random.Random(3)
    rows = [(i, f"g{rng.randint(0, 60)}", rng.randint(0, 30)) for i in range(400)]
    got = shard(spark.createDataFrame(rows, "i long, g string, n int"), 200, F.col("g"), F.col("n")).collect()
    total, where = Counter(), {}
    for r in got:
        assert where.setdefault(r.g, r.shard_id) == r.shard_id
        total[r.shard_id] += r.n
    groups = Counter()
    for _, g, n in rows:
        groups[g] += n
    assert Counter(200 - t for t in total.values()) == brute(list(groups.values()), 200)


def test_edges(spark):
    rows = [(1, None, 5), (2, None, None), (None, "a", -3), (3, "big", 50), (3, "big", 50), (4, "null", 1)]
    df = spark.createDataFrame(rows, "i long, g string, n int").withColumn("shard_id", F.lit("clash"))
    got = shard(df, 60, F.col("g"), F.col("n"))
    assert got.columns == ["i", "g", "n", "shard_id"] and got.count() == 6
    by = {r.g: r.shard_id for r in got.collect()}
    assert by["big"] != by[None]
    assert shard(df.filter("false"), 60, F.col("g"), F.col("n")).count() == 0


def test_documents(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "same text", "x"), (4, "same text", "x"), (4, "same text", "x"), (None, "é" * 30, "x"), (5, None, "x"), (6, "w" * 5000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard_id string")
    out = shard_documents(df, 64)
    got = out.collect()
    assert out.columns == ["doc_id", "text", "shard_id"] and len(got) == len(rows)
    total, where = Counter(), {}
    for r in got:
        assert where.setdefault(r.text, r.shard_id) == r.shard_id
        total[r.shard_id] += len((r.text or "").encode())
    assert where["w" * 5000] not in {v for k, v in where.items() if k != "w" * 5000}
    assert Counter(64 - t for t in total.values()) == brute([0, 0, 27, 60, 5000], 64)
    assert shard_documents(df.filter("false")).count() == 0


def test_query_keeps_whole_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = query(spark, "/root/testdata/sf0.001")
    assert out.columns == [*docs.columns, "shard_id"]
    assert sorted(tuple(r)[:-1] for r in out.collect()) == sorted(map(tuple, docs.collect()))
