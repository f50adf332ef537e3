"""Every registered query against its independent SQL oracle (DuckDB) on
sf0.001; queries without an oracle must run and return rows."""

import math
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql.readwriter import DataFrameWriter

from conftest import SF001
import __spark_entry__ as entry
from playstream.sources.tables import TABLES, table_path

# the operators for training data are tested with their subpackage
QUERIES = {k: q for k, q in entry.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
ORACLES = {k: q for k, q in entry.oracle_sql().items() if k in QUERIES}
# no cartesian / nested-loop joins and no Python UDFs in any registered plan
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "PythonUDF")


def assert_plan_clean(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [k for k in FORBIDDEN if k in plan]


@pytest.fixture(autouse=True)
def written_plans(monkeypatch):
    """Check the plan of every table that a query writes on its way, too."""
    write = DataFrameWriter.parquet

    def checked(self, *args, **kwargs):
        assert_plan_clean(self._df)
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", checked)


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    out = []
    for r in pdf[cols].itertuples(index=False):
        out.append(tuple(None if (not hasattr(x, "__len__") and pd.isna(x)) else norm(x) for x in r))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF001, t)}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    got = df.toPandas()
    assert_plan_clean(df)
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF001)
    assert df.count() >= 1
    assert_plan_clean(df)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "win_rate" in df.columns
