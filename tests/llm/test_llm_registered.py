"""What the entry point registers, and the SQL of operators that SQL can express."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_licences_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(entry.oracle_sql()["op8_license_dice"]).fetchall()
    got = [tuple(r) for r in entry.queries()["op8_license_dice"](spark, SF).collect()]
    assert want and sorted(got) == sorted(want)
