"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import math

import duckdb
import pytest

from prismframe.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = duck.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(tuple(map(canonical, r)) for r in found.fetchall())
    assert sorted(tuple(canonical(r[c]) for c in columns) for r in df.collect()) == want
