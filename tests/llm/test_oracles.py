"""The registered queries against their SQL on the smallest tables."""

import duckdb
import pytest
from tests.test_registry import DATA, rows

from tidelog.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    mine = queries.queries()[name](spark, DATA).toPandas()
    other = con.execute(queries.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(other.columns)
    assert rows(mine) == rows(other)
