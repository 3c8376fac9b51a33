"""Every oracle pair, Spark against DuckDB, on the smallest scale factor."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from classbench.sources.tables import TABLES
from tests.conftest import SF_SMALL

ORACLE = E.oracle_sql()


def test_every_sql_has_a_query_and_entry_runs(spark):
    assert set(ORACLE) <= set(E.queries())
    out = E.entry(spark)
    assert out.count() == 5 and out.columns == ["metric", "value"]


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_pair(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)
