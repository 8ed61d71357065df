"""Every registered query against its SQL, on the smallest test tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from suite.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "flight_date",
        "origin_airport",
        "dest_airport",
        "total_revenue",
        "total_bookings",
    ]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    want = relation.select(*[f'"{c}"' for c in columns]).fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
