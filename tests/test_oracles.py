"""Every registered key against its DuckDB oracle (sf0.001, the driver uses sf0.01).

Compares column names, column type classes and the order-insensitive
multiset of rows, exactly (no tolerance)."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from queuelens.oracle import oracle_sql
from queuelens.plans.catalog import registry
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

QUERIES = {k: v for k, v in entry.queries().items() if k in registry()}   # the optional subpackage has its own tests
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "quantize"):
        return float(v)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return float(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_key_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) == set(registry())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, srows) == _rows(ocols, orows)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["category_name", "category_group", "sla_target_hours", "ticket_count",
                          "avg_resolution_hours", "sla_breach_pct"]
    assert df.count() > 0
