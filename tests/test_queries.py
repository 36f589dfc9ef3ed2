"""Every registered query at the smallest scale, against its SQL twin where there is one."""

import math

import duckdb
import pytest

import __spark_entry__ as registered
from tillstar.plans.catalog import CATALOG as QUERIES
from tillstar.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def order(row):
    return [(v is None, f"{v:030.6f}" if isinstance(v, (int, float)) else str(v)) for v in row]


def same(a, b):
    if isinstance(a, float) and isinstance(b, (int, float)):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def test_registered_names():
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLES) <= set(registered.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)
    # No SQL for fitted models and sketches.
    assert set(QUERIES) - set(ORACLES) == {
        "analytics_summary", "attribution", "attribution_permutation", "churn_gbt", "churn_logistic", "customer_scores",
        "m_active_customers_approx", "quantile_threshold_approx",
    }


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=order)
    if name not in ORACLES:
        assert rows
        return
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in found.fetchall()), key=order)
    assert len(rows) == len(want)
    assert all(same(a, b) for r, w in zip(rows, want) for a, b in zip(r, w))


def test_entry(spark):
    assert registered.entry(spark).count() == 12
