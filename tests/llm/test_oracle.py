"""Text operators that SQL can say, against DuckDB on the smallest tables."""

import glob
import os

import pytest

from clauseworks.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(map(tuple, df.select(*cols).collect()))
    assert got and got == sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({queries.oracle_sql()[name]})").fetchall())
