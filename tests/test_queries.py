"""Every registered query against its SQL in another engine, on the smallest table."""

import duckdb
import pandas as pd
import pytest

from millrace.plans.catalog import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    cell = lambda v: None if v is None or v != v else round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(map(str, map(cell, r))) for r in df[cols].astype(object).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, sf, duck, name):
    got, want = QUERIES[name](spark, sf).toPandas(), duck.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.count() >= 0 and df.columns


def test_entry_and_catalogue(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(QUERIES) <= set(e.queries())
