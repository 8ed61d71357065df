"""Adapters whose other side (a database, a row-level catalog) is not available in tests."""

import pytest

from cdclake.sources.jdbc import Split, key_ranges, read_jdbc, sqlserver_url
from cdclake.sources.lake import Lake, apply_changes, create_gold, create_silver
from cdclake.sources.row_level import merge_into
from cdclake.specs import entity
from util import ITEM, changes


class FakeReader:
    def __init__(self):
        self.calls = {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def option(self, key, value):
        self.calls[key] = value
        return self

    def options(self, **options):
        self.calls.update(options)
        return self

    def load(self):
        return self.calls

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "table": table, "predicates": predicates, **properties}


def session():
    return type("Session", (), {"read": FakeReader()})()


def test_url_accepts_comma_before_the_port():
    assert sqlserver_url(" db,1433 ", "shop") == "jdbc:sqlserver://db:1433;databaseName=shop;encrypt=false"


def test_single_and_split_reads():
    plain = read_jdbc(session(), "u", "dbo.payments", properties={"user": "me"})
    assert plain["dbtable"] == "dbo.payments" and plain["user"] == "me" and "numPartitions" not in plain
    split = read_jdbc(session(), "u", "t", driver="d", split=Split("id", 1, 100, 8))
    assert (split["driver"], split["partitionColumn"], split["numPartitions"]) == ("d", "id", "8")
    assert (split["lowerBound"], split["upperBound"]) == ("1", "100")


def test_text_keys_are_read_by_disjoint_ranges(spark):
    ranges = key_ranges("id", ["F", "M'N"])
    got = read_jdbc(session(), "u", "t", predicates=ranges)
    assert got["predicates"] == ranges and len(ranges) == 3
    keys = spark.createDataFrame([(k,) for k in ("A", "F", "Ga", "M'N", "Z", None)], "id string")
    hits = [keys.where(r.replace("''", "\\'")).count() for r in ranges]
    assert sum(hits) == 6 and hits == [2, 2, 2]
    assert key_ranges("id", []) == ["1 = 1"]


class Writer:
    """Records the clauses of a MERGE."""

    def __init__(self, calls):
        self.calls = calls

    def __getattr__(self, name):
        def record(*args):
            self.calls.append((name, *args))
            return self

        return record


@pytest.fixture
def merges(spark, monkeypatch):
    calls = []

    def merge(self, name, condition):
        calls.append(("into", name, self.columns))
        return Writer(calls)

    monkeypatch.setattr(type(spark.range(1)), "mergeInto", merge)
    return calls


def test_row_level_merge_has_the_three_clauses(spark, merges):
    merge_into("cat.silver.items_clean", changes(spark, [(1, "a", 1, "u", 1)]), ITEM)
    assert [c[0] for c in merges] == [
        "into", "whenMatched", "delete", "whenMatched", "update", "whenNotMatched", "insert", "merge",
    ]
    assert merges[0][1] == "cat.silver.items_clean"
    assert set(merges[4][1]) == {"name", "qty"} and set(merges[6][1]) == {"id", "name", "qty"}


def test_row_level_state_merge_lets_only_newer_changes_win(spark, merges):
    lake = Lake(spark, catalog="cat")
    apply_changes(lake, changes(spark, [(1, "a", 1, "d", 1)]), ITEM)
    assert [c[0] for c in merges] == ["into", "whenMatched", "update", "whenNotMatched", "insert", "merge"]
    assert merges[0][1:] == ("cat.silver.items_state", ["id", "name", "qty", "__op", "__source_ts_ms"])
    condition = str(merges[1][1])
    assert ">=" in condition and "cat.silver.items_state.__source_ts_ms" in condition
    assert set(merges[2][1]) == {"name", "qty", "__op", "__source_ts_ms"}


def test_catalog_tables_use_transforms(monkeypatch):
    statements = []
    fake = type("Session", (), {"sql": lambda self, text: statements.append(text)})()
    lake = Lake(fake, catalog="cat", provider="fmt", state_buckets=64)
    create_silver(lake, [entity("payments")])
    create_gold(lake)
    assert "cat.silver.payments_state" in statements[0] and "NOT NULL" in statements[0]
    assert "USING fmt PARTITIONED BY (months(created_at), bucket(64, payment_id))" in statements[0]
    assert statements[1].startswith("CREATE VIEW IF NOT EXISTS cat.silver.payments_clean")
    assert all("PARTITIONED BY (" in s and "OPTIONS" not in s for s in statements[2:])
