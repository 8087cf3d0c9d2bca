"""Every query with SQL against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from tallyforge import registry

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=str)
    told = con.sql(registry.oracle_sql()[name])
    assert sorted(told.columns) == columns
    at = [told.columns.index(c) for c in columns]
    assert got == sorted(([plain(r[i]) for i in at] for r in told.fetchall()), key=str)


def test_flagship(spark):
    assert registry.flagship(spark, DATA).count() > 0
