import corpus_pipeline as C
import pytest

import __spark_entry__ as E

from .test_near_duplicates import brute_pairs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    from prismframe.llm.common import cut, table

    docs, seen = table(spark, SF, "documents"), []
    for name, stage in C.STAGES:
        before, docs = docs, cut(stage(spark, docs, SF))
        seen.append((name, before, docs))
    return seen


def test_columns_and_order(stages):
    assert [n for n, *_ in stages] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "mixing to target weights", "sharding"]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(after.columns == columns for _, _, after in stages[:-1]) and stages[-1][2].columns == [*columns, "shard_id"]


def test_decisions_take_effect(stages):
    _, before, after = stages[1]
    kept = {r.doc_id for r in after.collect()}
    assert not [p for p in brute_pairs([(r.doc_id, r.text) for r in after.collect()])]
    pairs = brute_pairs([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id for r in before.collect()} - kept <= {x for p in pairs for x in p}
    bench = [r.text for r in before.sparkSession.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not [1 for r in stages[2][2].collect() for b in bench if b in r.text]
    assert {r.doc_id for r in stages[3][2].collect()} <= {r.doc_id for r in stages[2][2].collect()}
    assert stages[4][1].count() == stages[4][2].count()


def test_quality_keeps_clean_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    _, before, after = stages[0]
    kept = {r.doc_id for r in after.collect()}
    good = [r.doc_id for r in before.collect() if labels.get(r.doc_id) == 1]
    assert sum(i in kept for i in good) >= 0.98 * len(good)


def test_registered():
    q = E.queries()
    assert "pipeline" in q and {n.split("_")[0] for n in q if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}


ROWS = [
    (1, None, None, None, None, "x"), (None, "", "en", "src1", 0, "x"), (2, "a few plain words that say nothing", "en", "src1", 34, "x"), (2, "a few plain words that say nothing", "en", "src1", 34, "x"),
    (3, "a few plain words that say nothing", "en", "src1", 34, "x"), (4, "w " * 40000, "en", None, 1, "x"), (5, None, "de", "odd", None, "x"), (6, "***", "en", "src2", 3, "x"),
]


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_edges_of_every_stage(spark, name):
    stage = dict(C.STAGES)[name]
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long, node string")
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns + (["shard_id"] if name == "sharding" else [])
    got = [tuple(r)[:6] for r in out.collect()]
    assert set(got) <= set(ROWS)
    if name == "n-gram Jaccard join":
        assert sorted(map(repr, got)) == sorted(map(repr, [r for r in dict.fromkeys(ROWS) if r[0] != 3]))
    elif name in ("benchmark decontamination", "sharding"):
        assert sorted(map(repr, got)) == sorted(map(repr, ROWS))
    none = stage(spark, docs.filter("false"), SF)
    assert none.columns == out.columns and none.count() == 0
