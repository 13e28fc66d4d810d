"""Every registered query with SQL against DuckDB on the smallest tables."""

import decimal
import math

import duckdb
import pytest

from snaplake.plans import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v) + 0.0:.6g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    ran = duck.execute(SQL[name])
    names = [x[0] for x in ran.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in ran.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0
