"""What held on small tables and not on large ones: copies, cancelling words, wide radii, repeated work."""

import numpy as np
from pyspark.sql import functions as F


def test_copies_of_a_title_are_one_class(spark, monkeypatch):
    from prismframe.operators import dedup

    monkeypatch.setattr(dedup, "BLOCK_IDS", 3)
    monkeypatch.setattr(dedup, "TASK_PAIRS", 50)
    rng = np.random.default_rng(1)
    sets = [sorted(rng.choice(list("abcdefghij"), rng.integers(0, 7), replace=False).tolist()) for _ in range(40)] + [list("abcde")] * 15 + [list("abcdef")] * 4
    data = list(enumerate(sets)) + [(3, list("abcde")), (None, list("abcde"))]  # an id that repeats, and none
    want = []
    for i, (x, v) in enumerate(data):
        for y, w in data[i + 1 :]:
            if x is not None and y is not None and x != y and v and w and len(set(v) & set(w)) / len(set(v) | set(w)) >= 0.6:
                want.append((min(x, y), max(x, y), round(len(set(v) & set(w)) / len(set(v) | set(w)), 6)))
    df = spark.createDataFrame(data, "id long, w array<string>")
    assert sorted(map(tuple, dedup.similar_titles(df, "id", F.col("w"), digits=6).collect())) == sorted(want)
    classes = spark.createDataFrame([(0, list("abcde"), 15), (1, list("abcdef"), 4)], "c long, w array<string>, n long")
    assert [tuple(r) for r in dedup._similar_sets(classes, 0.6).collect()] == [(0, 1, 5 / 6)]


def test_texts_with_words_have_weight(spark, tmp_path):
    from prismframe.queries import QUERIES
    from prismframe.sources.encoding import hashing_encoder

    signed = {}
    for i in range(2000):
        v = hashing_encoder()([f"w{i}"])[0]
        signed.setdefault(int(np.flatnonzero(v)[0]), {})[int(v.sum())] = f"w{i}"
    cancelling = next(f"{x[1]} {x[-1]}" for x in signed.values() if len(x) == 2)
    texts = [cancelling, "one two", "\n\t", " ", "", "  ", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.dims, r.norm) for r in QUERIES["encoded_documents"](spark, str(tmp_path)).collect()}
    assert got == {0: (64, 1.0), 1: (64, 1.0), 2: (64, 1.0), 3: (64, 0.0), 4: (64, 0.0), 5: (64, 0.0), 6: (64, 0.0)}


def test_clusters_of_many_tiles_are_those_of_one_task(spark, monkeypatch):
    from prismframe.operators import hdbscan, similarity

    monkeypatch.setattr(similarity, "CELL_ROWS", 40)
    rng = np.random.default_rng(4)
    for n in (400, 3):
        x = np.concatenate([c + 0.2 * rng.normal(size=(n // 4 + 1, 6)) for c in rng.normal(size=(4, 6))])[:n].astype(np.float32)
        df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)] + [(i, v.tolist(), None) for i, v in enumerate(x[:9])], "id long, v array<float>, day int")
        got = {(r.day, r.id): (r.cluster, r.persistence) for r in hdbscan.hdbscan(df, ["day"], "id", "v").collect()}
        want = {}
        for day, rows in ((1, x), (None, x[:9])):
            labels, persistence = hdbscan.cluster_points(rows, 3)
            want |= {(day, i): v for i, v in enumerate(zip(labels.tolist(), persistence.tolist(), strict=True))}
        assert set(got) == set(want) and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) <= 1e-8 * want[k][1] for k in want)
        assert similarity.blocked(df.selectExpr("day AS g", "id", "v").filter("g = 1")).select("block").distinct().count() == (10 if n > 3 else 1)


def test_wide_radius_copies_vectors_no_more_as_they_grow(spark, monkeypatch):
    from prismframe.operators import similarity

    monkeypatch.setattr(similarity, "CELL_ROWS", 10)
    monkeypatch.setattr(similarity, "BLOCKS", 3)
    monkeypatch.setattr(similarity, "CHUNK_ROWS", 7)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = 1 - x.astype(float) @ x.T.astype(float) <= 0.25
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None)], "id long, v array<float>")
    sent, plain = [], similarity.tiled

    def watched(placed, run, schema):
        def counted(key, left, right):
            assert len(left) + len(right) < 300  # of three blocks a task has two at most
            return run(key, left, right)

        sent.append(placed.agg(F.max("h")).first()[0])
        return plain(placed, counted, schema)

    monkeypatch.setattr(similarity, "tiled", watched)
    assert {r.id: r.n for r in similarity.neighbour_counts(df, "id", "v", 0.25).collect()} == {i: int(k) for i, k in enumerate(near.sum(1)) if k}
    core = near.sum(1) >= 4
    root = {i: i for i in range(300) if core[i]}
    for _ in range(300):
        root = {i: min([root[i], *(root[j] for j in np.flatnonzero(near[i]) if core[j])]) for i in root}
    want = {i: root.get(i, min([root[j] for j in np.flatnonzero(near[i]) if core[j]], default=-1)) for i in range(300)} | {900: -1}
    assert {r.id: r.cluster for r in similarity.dbscan(df, "id", "v", 0.25, 5).collect()} == want
    assert sent == [3, 3, 3] and len(set(want.values())) > 3


def test_texts_are_split_once(spark, monkeypatch):
    from prismframe.operators import terms
    from prismframe.queries import QUERIES
    from prismframe.queries.terms import _tilt

    sf = "/root/testdata/sf0.001"
    assert not any("documents.parquet" in f for f in _tilt(spark, sf).inputFiles())
    tests, control = [], terms.benjamini_hochberg
    monkeypatch.setattr(terms, "benjamini_hochberg", lambda t, *rest: tests.append(t) or control(t, *rest))
    QUERIES["tilt_significance"](spark, sf)
    assert "ArrowEvalPython" not in tests[0]._jdf.queryExecution().executedPlan().toString()
    calls, plain = [], terms.count_rows
    monkeypatch.setattr(terms, "count_rows", lambda *a: calls.append(a) or plain(*a))
    QUERIES["distinctive_phrases"](spark, sf)
    assert len(calls) == 1


def test_rare_terms_count_in_totals_only(spark):
    from prismframe.operators.terms import against_cohort

    data = [("a", "x", "t", 2), ("a", "x", "u", 1), ("b", "x", "t", 1), ("b", "x", "v", 3), ("c", "y", "t", 4)]
    found = spark.createDataFrame(data, "bucket string, lang string, term string, n long")
    got = against_cohort(found, least=2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, against_cohort(found).filter("a >= 2").collect())) == [("a", "x", "t", 2, 1, 3, 4), ("b", "x", "v", 3, 0, 4, 3), ("c", "y", "t", 4, 0, 4, 1)]
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
