"""Every registered query against its DuckDB statement (the driver's check)."""

import decimal
import importlib.util
import math
import os

import duckdb
import pytest

from conftest import SF_SMALL

spec = importlib.util.spec_from_file_location(
    "entry", os.path.join(os.path.dirname(__file__), "..", "__spark_entry__.py"))
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    return v


def _rows(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    from tidemark.plans.queries import ORACLE, QUERIES
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _rows(df.select(*cols).collect())
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    want = _rows(rel.select(*[f'"{c}"' for c in cols]).fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns == ["customer_id", "customer_name", "customer_segment", "nb_orders",
                          "total_revenue"]
