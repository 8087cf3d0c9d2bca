"""References that several parts share: a result that the SQL allows, the same in any order of the rows."""

import datetime

import duckdb
import pytest

from tallyforge import registry
from test_queries import plain

#: All of 1000000 to 1000009 are cut to the reference of 100000.
PARTS = [7, 100000, *range(1000000, 1000010)]
NAMES = ["match_cascade", "pack_inference", "decided_prices", "aberrant_prices", "item_state", "price_alerts", "price_buckets"]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    part = [(k, f"part {k}", f"Brand#{k % 3}", "PROMO", k % 9, 100.0 + k % 10) for k in PARTS]
    day = datetime.datetime(1998, 1, 1)
    line = [(10 * k + n, k, k % 5, n, 2.0, 2.0 * (90 + 17 * (k % 10) + n), 0.1, 0.02, "R", "O", day) for k in PARTS for n in (1, 2, 3)]
    made = []
    for step in (1, -1):
        folder = str(tmp_path_factory.mktemp("ties"))
        spark.createDataFrame(part[::step], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{folder}/part.parquet")
        spark.createDataFrame(line[::step], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
        made.append(folder)
    return made


@pytest.mark.parametrize("name", NAMES)
def test_ties(spark, folders, name):
    sql = registry.oracle_sql()[name]
    assert sql.count("ORDER BY ordinal)") == 2
    for folder in folders:
        con = duckdb.connect()
        for t in ("part", "lineitem"):
            con.sql(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
        told = con.sql(sql.replace("ORDER BY ordinal)", "ORDER BY ordinal, supplier_ref, k)"))
        df = registry.queries()[name](spark, folder).select(*told.columns)
        assert sorted(([plain(v) for v in r] for r in df.collect()), key=str) == sorted(([plain(v) for v in r] for r in told.fetchall()), key=str)


#: Keys past six digits too, but no two are cut to the same reference.
ALONE = [7, *range(1000000, 1000300, 11)]
ALONE_NAMES = ["aberrant_prices", "match_cascade", "price_alerts", "decided_prices", "price_buckets", "item_state", "pack_inference"]


@pytest.fixture(scope="module")
def alone(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("alone"))
    part = [(k, f"part {k}", f"Brand#{k % 3}", "PROMO", k % 9, 100.0 + k % 10) for k in ALONE]
    day = datetime.datetime(1998, 1, 1)
    line = [(10 * k + n, k, k % 5, n, 2.0, 2.0 * (90 + 170 * (k % 10) + n), 0.1, 0.02, "R", "O", day) for k in ALONE for n in (1, 2, 3)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame(line, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.mark.parametrize("name", ALONE_NAMES)
def test_no_ties(spark, alone, name):
    """Without shared references the rows are those of the SQL as it stands, so ties are all that sets them apart."""
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.sql(f"create view {t} as select * from '{alone}/{t}.parquet/*.parquet'")
    told = con.sql(registry.oracle_sql()[name])
    df = registry.queries()[name](spark, alone).select(*told.columns)
    assert sorted(([plain(v) for v in r] for r in df.collect()), key=str) == sorted(([plain(v) for v in r] for r in told.fetchall()), key=str)
