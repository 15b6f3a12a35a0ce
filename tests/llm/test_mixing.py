import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from prismframe.llm import mixing as M


def test_fill_gives_shortages_to_siblings():
    assert M.fill(100, [(1, 10), (1, 1000), (2, 1000)]) == pytest.approx([10, 30, 60])
    assert M.fill(100, [(1, 10), (1, 20), (0, 100)]) == pytest.approx([10, 20, 70])
    assert M.fill(100, [(1, 10), (3, 20)]) == pytest.approx([10, 20])
    assert M.fill(5, []) == [] and M.fill(0, [(1, 5)]) == [0]


def slow_quotas(tokens, weights, budget, epochs):
    """Round by round: every open child gets its share of what is left until it is full."""
    def down(prefix, amount):
        paths = [p for p in tokens if p[: len(prefix)] == prefix]
        if len(prefix) == 3:
            return {prefix: amount}
        kids = sorted({p[: len(prefix) + 1] for p in paths}, key=str)
        room = {k: epochs * sum(t for p, t in tokens.items() if p[: len(k)] == k) for k in kids}
        got, left = dict.fromkeys(kids, 0.0), amount
        while left > 1e-9:
            open_ = [k for k in kids if got[k] < room[k] - 1e-9 and weights.get(k, 1) > 0]
            if not open_:
                break
            total = sum(weights.get(k, 1) for k in open_)
            give = min([left] + [(room[k] - got[k]) * total / weights.get(k, 1) for k in open_])
            for k in open_:
                got[k] += give * weights.get(k, 1) / total
            left -= give
        out = {}
        for k in kids:
            out |= down(k, got[k])
        return out

    return down((), min(budget, epochs * sum(tokens.values())))


def test_quotas_against_slow_filling():
    rng = random.Random(4)
    for _ in range(100):
        tokens = {(rng.choice("ab"), rng.choice("xy"), rng.choice("12")): rng.randint(1, 100) for _ in range(6)}
        weights = {p[:k]: rng.choice([0.5, 1, 3]) for p in tokens for k in (1, 2, 3)}
        budget = rng.randint(1, 900)
        got, want = M.leaf_quotas(tokens, weights, budget, 3), slow_quotas(tokens, weights, budget, 3)
        assert all(abs(got[p] - want[p]) <= 1 for p in tokens)


def brute_prefix(rows, rest):
    out, total = set(), 0
    for i, t in rows:
        total += t
        if total > rest:
            break
        out.add(i)
    return out


@pytest.mark.parametrize("slice_docs", [5000, 7])
def test_selection_is_the_seeded_prefix(spark, monkeypatch, slice_docs):
    monkeypatch.setattr(M, "SLICE_DOCS", slice_docs)
    rng = random.Random(6)
    rows = [(i, rng.choice(["en", "fr"]), rng.choice(["s0", "s1", "s2"]), "w " * rng.randint(0, 9), rng.randint(0, 40)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string, n int").withColumn("h", F.lit(1))
    weights = {("d",): 1.0, ("d", "fr"): 3.0, ("d", "fr", "s0"): 4.0}
    got = Counter((r.doc_id, r.epoch) for r in M.mix(df, weights, F.lit("d"), F.col("n"), budget=6000, max_epochs=2.5).collect())
    tokens = Counter()
    for _, lang, source, _, n in rows:
        tokens["d", lang, source] += n
    quotas = M.leaf_quotas(dict(tokens), weights, 6000, 2.5)
    want = Counter()
    for path, quota in quotas.items():
        full, rest = divmod(quota, tokens[path])
        mine = [r for r in rows if (r[1], r[2]) == path[1:]]
        order = {r.doc_id: r.h for r in spark.createDataFrame([(r[0],) for r in mine], "doc_id long").select("doc_id", F.xxhash64(F.lit(17), F.lit(full).cast("long"), "doc_id").alias("h")).collect()}
        for r in mine:
            for e in range(full):
                want[r[0], e] += 1
        for i in brute_prefix([(r[0], r[4]) for r in sorted(mine, key=lambda r: order[r[0]])], rest):
            want[i, full] += 1
    assert got == want
    total = sum(dict((r[0], r[4]) for r in rows)[i] * k for (i, _), k in got.items())
    assert 6000 - 40 * len(quotas) <= total <= 6000


def test_edges(spark):
    rows = [(1, None, None, "a b", "x"), (None, "en", "src1", "a b c", "x"), (None, "en", "src1", "a b c", "x"), (4, "en", "src1", None, "x"), (5, "de", "odd", "", "x"), (6, "en", "src9999999999", "w " * 50000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string, epoch string")
    out = M.mix_documents(df)
    assert out.columns == ["doc_id", "lang", "source", "text", "epoch"] and out.count() > 0
    assert M.mix_documents(df, epoch_col=None).columns == df.columns
    assert M.mix_documents(df.filter("false")).count() == 0
    assert [r[0] for r in df.select(M.words(F.col("text"))).collect()] == [2, 3, 3, None, 0, 50000]
