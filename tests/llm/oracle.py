"""Runs a registered query and its SQL and compares all values."""
import duckdb
import pandas as pd

from playstream.llm.queries import ORACLES, QUERIES
from playstream.sources.tables import TABLES, table_path

SF001 = "/root/testdata/sf0.001"


def values(pdf):
    return sorted((tuple(None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in r)
                   for r in pdf[sorted(pdf.columns)].itertuples(index=False)), key=repr)


def assert_matches_sql(spark, name, sf_dir=SF001):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    got, want = QUERIES[name](spark, sf_dir).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert values(got) == values(want)
