"""Every registered query against its DuckDB oracle (sf0.001), like the driver's correctness gate."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "success_rate_pct" in df.columns


def test_every_query_has_an_oracle(spark):
    from tierwise.plans.oracle import oracle_sql
    from tierwise.plans.queries import queries

    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(rel.columns, rel.fetchall())
