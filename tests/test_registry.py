"""Every registered query of the engine against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

from tidelog import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def cell(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, float):
        return round(x, 6)
    return x.item() if hasattr(x, "item") else x


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    return sorted((tuple(cell(x) for x in r) for r in df.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, duck, name):
    mine = registry.queries()[name](spark, DATA).toPandas()
    other = duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(other.columns)
    a, b = rows(mine), rows(other)
    assert len(a) == len(b)
    assert a == b
