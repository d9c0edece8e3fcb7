"""Every query of the core against its DuckDB statement, on the smallest tables."""

import glob
import os

import pytest

from clauseworks.plans import catalogue

SF = "/root/testdata/sf0.001"
#: Queries that have rows in the larger tables only.
SPARSE = ("audit_weak_evidence", "review_missing")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def plain(v):
    if isinstance(v, bool) or v is None:
        return None if v is None else int(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return round(float(v), 6) if hasattr(v, "as_integer_ratio") else v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((plain(tuple(r)) for r in df.select(*cols).collect()), key=repr)
    assert len(got) > 0 or name in SPARSE
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        return
    wanted = duck.sql(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
    assert got == sorted(map(plain, wanted), key=repr)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
