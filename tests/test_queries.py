"""Every registered query of the base library against its oracle, at the smallest scale."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from tidewire import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(df):
    cell = lambda v: None if pd.isna(v) else str(int(v)) if isinstance(v, float) and v == int(v) else str(v)
    return sorted(tuple(map(cell, r)).__repr__() for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, oracle, name):
    assert rows(registry.QUERIES[name](spark, SF).toPandas()) == rows(oracle.sql(registry.ORACLES[name]).df())
