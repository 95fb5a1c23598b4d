"""Every query with an oracle against DuckDB on the smallest tables; the others run."""

import numbers
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(df: pd.DataFrame) -> list[tuple]:
    def value(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
            return ""
        return f"{float(v):.9g}" if isinstance(v, numbers.Number) and not isinstance(v, (bool, np.bool_)) else str(v)

    return sorted(tuple(value(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLE)))
def test_oracle(spark, duck, name):
    mine, theirs = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLE[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert plain(mine.astype(object)) == plain(theirs.astype(object))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0 or name == "op9_decontamination"


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(ORACLE) <= set(QUERIES)
