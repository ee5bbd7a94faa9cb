"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from priceframe.plans import catalog

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_canon(r[i]) for i in order) for r in rows)
    return [cols[i] for i in order], hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["year", "avg_price", "min_price", "max_price", "n_obs"]


def test_every_query_has_oracle_or_is_declared_rows_only():
    from priceframe.plans import catalog

    rows_only = set(catalog.queries()) - set(catalog.oracle_sql())
    assert rows_only == {"link_fuzzy_ratio", "box_stats_approx"}


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert _digest(sdf.columns, [tuple(r) for r in sdf.collect()]) == _digest(dcols, res.fetchall())


def test_model_queries_run(spark):
    pred = E.queries()["predict"](spark, SF_SMALL)
    assert {"prediction", "dollar_price"} <= set(pred.columns)
    coef = E.queries()["model_coefficients"](spark, SF_SMALL).collect()
    assert [r["term"] for r in coef] == ["intercept", "GDP_dollar", "dollar_ex", "year"]
