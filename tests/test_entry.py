"""The driver's contract, and the catalogue against DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tabweave import catalog

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
def test_flagship(spark):
    out = entry.entry(spark)
    assert out.columns == ["l_returnflag", "l_linestatus", "revenue", "avg_disc", "orders"] and out.count() > 0


def _norm(df: pd.DataFrame) -> list:
    def one(v):
        if not isinstance(v, list) and pd.isna(v):
            return "None"
        try:
            return repr(round(float(v), 4))
        except (TypeError, ValueError):
            return str(v)
    return sorted(tuple(one(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@needs_data
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_catalogue(spark, name):
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    got = catalog.QUERIES[name](spark, DATA).toPandas()
    if name not in catalog.ORACLES:
        assert len(got)
        return
    want = con.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _norm(got) == _norm(want)


@needs_data
def test_relational_plans_have_no_python(spark):
    for name in ("flagship", "filter_num_text", "join_norm_key", "agg_key_norm", "pivot_sum", "profile_orders"):
        plan = catalog.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
