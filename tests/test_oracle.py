"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for n in TABLES:
        c.execute(f"CREATE VIEW {n} AS SELECT * FROM '{SF_SMALL}/{n}.parquet'")
    return c


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    return str(v)


QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    if name not in ORACLES:
        assert df.columns
        return
    rel = con.execute(ORACLES[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    cols = sorted(dcols)
    si = [df.columns.index(c) for c in cols]
    di = [dcols.index(c) for c in cols]
    a = sorted(tuple(norm(r[i]) for i in si) for r in rows)
    b = sorted(tuple(norm(r[i]) for i in di) for r in drows)
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 33 and df.columns == ["rule_id", "name", "rule_group", "findings",
                                               "triggered"]


def test_every_rule_has_a_full_window_query():
    assert {rid for rid, window, _ in E.RULE_QUERIES.values() if window == E.ALL} == set(E.ALL_RULE_IDS)
