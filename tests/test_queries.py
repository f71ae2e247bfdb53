"""Every query against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

from quillspan.plans import coverage, operations, records

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = coverage.QUERIES | operations.QUERIES | records.QUERIES
SQL = coverage.SQL | operations.SQL | records.SQL


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    r = duck.execute(SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(x[names.index(c)]) for c in columns) for x in r.fetchall())
