"""Each query against its SQL in DuckDB on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from stemma.plans import load, registry

load()
FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return round(float(v), 6)
    return v


def rows(df):
    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_as_sql(spark, con, name):
    got, want = registry.QUERIES[name](spark, FOLDER).toPandas(), con.sql(registry.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_resolved_ids_keep_the_invariants(spark):
    out = registry.QUERIES["resolve_ids"](spark, FOLDER).toPandas()
    assert out["id"].notna().all() and len(out) == spark.read.parquet(f"{FOLDER}/part.parquet").count()
    assert (out.groupby("hash")["id"].nunique() == 1).all() and (out.groupby("id")["hash"].nunique() == 1).all()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
