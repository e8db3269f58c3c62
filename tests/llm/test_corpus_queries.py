"""Every corpus query with SQL against it, and what the learned ones get right on rows they have not seen."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from tidewire.llm import registry

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(df):
    cell = lambda v: None if pd.isna(v) else str(int(v)) if isinstance(v, float) and v == int(v) else str(v)
    return sorted(tuple(map(cell, r)).__repr__() for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, oracle, name):
    assert rows(registry.QUERIES[name](spark, SF).toPandas()) == rows(oracle.sql(registry.ORACLES[name]).df())


def test_languages_of_held_out_documents(spark, oracle):
    found = registry.QUERIES["op9_language_id"](spark, SF).toPandas()  # noqa: F841, DuckDB reads it
    right, n = oracle.sql("SELECT avg(CAST(lang_pred = lang AS INT)), count(*) FROM found JOIN documents USING (doc_id) WHERE held_out AND lang IS NOT NULL AND lang_pred <> 'und'").fetchall()[0]
    assert n > 100 and right >= 0.98


def test_toxicity_of_held_out_documents(spark, oracle):
    """Few toxic documents are labelled at this scale, and some labels are noise."""
    found = registry.QUERIES["op4_toxicity"](spark, SF).toPandas()  # noqa: F841, DuckDB reads it
    counts = dict(oracle.sql("SELECT toxic, [sum(predicted), count(*)] FROM found JOIN labels USING (doc_id) WHERE held_out AND toxic IS NOT NULL GROUP BY toxic").fetchall())
    assert counts[1][0] >= 0.6 * counts[1][1] and counts[0][0] <= 0.03 * counts[0][1]
