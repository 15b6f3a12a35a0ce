"""Queries that SQL can't express, held to plain Python on the smallest tables."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from prismframe.functions.text import signal_text, title_tokens
from prismframe.operators import quality
from prismframe.operators.hdbscan import cluster_points
from prismframe.queries import ORACLES, QUERIES
from prismframe.queries.quotes import _carriers
from prismframe.queries.registry import articles, quotes
from prismframe.queries.terms import _tilt

SF = "/root/testdata/sf0.001"
COVERED = {"headline_strip", "briefing_novelty", "frame_share_intervals", "lag_significance", "tilt_significance", "input_pins", "stable_sample", "quote_extraction", "hdbscan"}


def test_every_query_without_sql_is_here():
    assert set(QUERIES) - set(ORACLES) == COVERED


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_headline_strip(spark):
    want = []
    by = defaultdict(list)
    for r in quotes(spark, SF).collect():
        by[r.story].append((r.idx, r.frame, r.speaker_type))
    for story, items in by.items():
        kept = []
        for x in sorted(items):
            if len(kept) < 4 and all(x[1] != k[1] and x[2] != k[2] for k in kept):
                kept.append(x)
        want += [(story, *k) for k in kept]
    assert sorted((r.story, r.idx, r.frame, r.speaker_type) for r in rows(spark, "headline_strip")) == sorted(want)


def test_briefing_novelty(spark):
    s = signal_text(F.col("body"), F.col("summary"), F.col("title"))
    by, want = defaultdict(list), []
    for r in articles(spark, SF).select("doc_id", "story", "outlet", title_tokens(F.col("title")).alias("w"), s["level"].alias("level"), F.length(s["text"]).alias("n")).collect():
        by[r.story, r.outlet].append(({"body": 0, "summary": 1}.get(r.level, 2), -r.n, r.doc_id, set(r.w)))
    for key, items in by.items():
        kept = []
        for x in sorted(items, key=lambda i: i[:3]):
            new = all(not (x[3] | k[3]) or len(x[3] & k[3]) / len(x[3] | k[3]) < 0.6 for k in kept)
            if len(kept) < 2 and new:
                kept.append(x)
        want += [(*key, k[2], i) for i, k in enumerate(kept)]
    assert sorted((r.story, r.outlet, r.doc_id, r.kept_rank) for r in rows(spark, "briefing_novelty")) == sorted(want)


def test_frame_share_intervals(spark):
    carriers, weights = _carriers(spark, SF)
    each = {(r.frame, r.bucket) for r in carriers.collect()}
    weight = {r.bucket: r.weight for r in weights.collect()}
    buckets = sorted({b for _, b in each})
    w = np.array([weight.get(b, 1.0) for b in buckets])
    got = {r.frame: (r.low, r.high) for r in rows(spark, "frame_share_intervals")}
    assert set(got) == {f for f, _ in each}
    for frame, (low, high) in got.items():
        x = np.array([(frame, b) in each for b in buckets], float)
        rng = np.random.default_rng(42)
        draws = []
        for _ in range(1000):
            at = rng.integers(0, len(x), len(x))
            draws.append((x[at] @ w[at]) / w[at].sum())
        assert math.isclose(low, np.percentile(draws, 5), abs_tol=1e-9) and math.isclose(high, np.percentile(draws, 95), abs_tol=1e-9)


def benjamini(p, q=0.05):
    order = sorted(p)
    limit = max((x for k, x in enumerate(order, 1) if x <= k / len(order) * q), default=-1)
    return [x <= limit for x in p]


def t_tail(t, dof):
    """Two-sided, by integrating the density."""
    x = np.linspace(0, abs(t), 200_001)
    f = np.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(dof * math.pi) * (1 + x * x / dof) ** (-(dof + 1) / 2)
    return 1 - 2 * float(((f[1:] + f[:-1]) / 2).sum() * (x[1] - x[0]))


def test_lag_significance(spark):
    tests = [r for r in rows(spark, "lagged_correlation") if r.r is not None]
    p = []
    for r in tests:
        dof = r.n - 2
        t = r.r * math.sqrt(dof / max(1 - r.r * r.r, 1e-300))
        p.append(0.0 if abs(r.r) >= 1 else math.erfc(abs(t) / math.sqrt(2)) if dof >= 30 else t_tail(t, dof))
    want = {(r.a, r.b, r.story, r.lag): (x, s) for r, x, s in zip(tests, p, benjamini(p), strict=True) if x <= 0.05}
    got = {(r.a, r.b, r.story, r.lag): (r.p, r.significant) for r in rows(spark, "lag_significance")}
    assert set(got) == set(want) and all(math.isclose(got[k][0], want[k][0], abs_tol=1e-7) and got[k][1] == want[k][1] for k in want)


def test_tilt_significance(spark):
    families = defaultdict(list)
    for r in _tilt(spark, SF).filter("z <> 0").collect():
        families[r.bucket, "positive" if r.z > 0 else "negative"].append((r.term, math.erfc(abs(r.z) / math.sqrt(2))))
    want = set()
    for (bucket, side), terms in families.items():
        want |= {(bucket, side, t, s) for (t, p), s in zip(terms, benjamini([p for _, p in terms]), strict=True) if p <= 0.05}
    assert {(r.bucket, r.side, r.term, r.significant) for r in rows(spark, "tilt_significance")} == want


def test_input_pins(spark):
    got = {r.table: (r.n, r.hash) for r in rows(spark, "input_pins")}
    again = {t: spark.read.parquet(f"{SF}/{t}.parquet").orderBy(F.rand(3)).repartition(3) for t in got}
    assert got == {r.table: (r.n, r.hash) for r in quality.pin(again).collect()}
    other = quality.pin({"region": again["region"].withColumn("r_name", F.upper(F.concat("r_name", F.lit("x"))))}).first()
    assert other.hash != got["region"][1] and got["nation"][0] == again["nation"].count()


def test_stable_sample(spark):
    got = [r.doc_id for r in rows(spark, "stable_sample")]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source")
    from prismframe.operators.selection import stable_sample

    assert len(got) == len(set(got)) == min(200, docs.count())
    few = {r.doc_id for r in stable_sample(docs, "doc_id", 20).collect()}
    assert few == {r.doc_id for r in stable_sample(docs.repartition(7).orderBy(F.rand(1)), "doc_id", 20).collect()} and len(few) == 20


def test_quote_extraction(spark):
    want = []
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        plain = "".join(" " if c in '"“”«»„\n' else c for c in r.text or "")
        if len(plain) >= 5:
            want += [(r.conv_id, r.turn, plain, "Ana Ruiz", "said"), (r.conv_id, r.turn, plain, "Bo Chen", "added")]
    assert sorted((r.conv_id, r.turn, r.quote, r.speaker, r.verb) for r in rows(spark, "quote_extraction")) == sorted(want)


def test_hdbscan(spark):
    vectors = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect())
    x = np.array([v for _, v in vectors], float)
    got = {r.vec_id if "vec_id" in r.__fields__ else r.id: r for r in rows(spark, "hdbscan")}
    assert set(got) == {i for i, _ in vectors}
    labels, _ = cluster_points(x, 3)
    mine = [next(v for k, v in got[i].asDict().items() if k in ("cluster", "label")) for i, _ in vectors]
    pairs = defaultdict(set)
    for a, b in zip(labels.tolist(), mine, strict=True):
        pairs[a].add(b)
    assert all(len(v) == 1 for v in pairs.values()) and len({next(iter(v)) for v in pairs.values()}) == len(pairs)


@pytest.mark.parametrize("eps", [0.02, 0.3, 0.62])
def test_neighbours_against_all_pairs(spark, monkeypatch, eps):
    from prismframe.operators import similarity

    monkeypatch.setattr(similarity, "CELL_ROWS", 20)
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    x = np.concatenate([c + 0.1 * rng.normal(size=(40, 8)) for c in rng.normal(size=(5, 8))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None)], "id long, v array<double>")
    got = [tuple(r) for r in similarity.neighbours(df, "id", "v", eps).collect()]
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(1 - x @ x.T <= eps), strict=True) if a != b}
    assert len(got) == len(set(got)) and set(got) == want
    assert similarity.neighbours(df.filter("id = 900"), "id", "v", eps).count() == 0


def test_false_discovery_against_sorting(spark):
    from prismframe.operators.terms import benjamini_hochberg, bonferroni

    rng = np.random.default_rng(2)
    p = [*(rng.random(300) ** 4).round(4).tolist(), 0.0, 1e-12, 1e-300, 1.0]
    data = [(i, f"f{i % 3}" if i % 3 else None, x) for i, x in enumerate(p)] + [(999, "f1", None)]
    df = spark.createDataFrame(data, "i long, fam string, p double")
    for family in ([], ["fam"]):
        got = {r.i: r.significant for r in benjamini_hochberg(df, "p", family).collect()}
        want = {999: False}
        for key in {r[1] for r in data} if family else {0}:
            mine = [r for r in data if r[2] is not None and (not family or r[1] == key)]
            want |= dict(zip([r[0] for r in mine], benjamini([r[2] for r in mine]), strict=True))
        assert got == want
    assert bonferroni(df.filter("p IS NOT NULL"), "p", []).filter("significant").count() == sum(x <= 0.05 / len(p) for x in p)
