import pytest
from pyspark.sql import functions as F

from cdclake.operators.quality import (
    apply_defaults,
    check_domain,
    check_fk,
    check_not_null,
    check_pk,
    check_unique,
    domain_violations,
)
from cdclake.operators.reconcile import (
    count_diff_by,
    count_reconciliation,
    duplicate_summary,
    event_total,
    pk_duplicates,
    sample_violations,
    state_mismatch,
)
from cdclake.plans.jobs import run_reconciliation
from cdclake.specs import entity
from conftest import rows
from util import ITEM, at, table


def test_counts_have_one_scan_per_side_and_no_join(spark):
    src, slv = table(spark, [(1, "a", 1), (2, "b", 1)]), table(spark, [(1, "a", 1)])
    got = count_reconciliation({"items": (src, slv), "same": (src, src), "empty": (slv, slv.limit(0))})
    assert rows(got) == [("empty", 1, 0, -1), ("items", 2, 1, -1), ("same", 2, 2, 0)]
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_duplicates(spark):
    df = table(spark, [(1, "a", 1), (1, "b", 1), (2, "c", 1), (None, "d", 1), (None, "e", 1)])
    assert rows(pk_duplicates(df, ITEM)) == [(1, 2), (None, 2)]
    assert rows(duplicate_summary({"items": (df, ITEM), "ok": (df.limit(0), ITEM)})) == [
        ("items", 2),
        ("ok", 0),
    ]
    assert rows(sample_violations(pk_duplicates(df, ITEM), "id", n=1)) == [(None, 2)]


def test_mismatch_null_rules_and_missing_keys(spark):
    src = table(spark, [(1, "A", 0), (2, None, 0), (3, "A", 0), (4, "A", 0), (None, "A", 0)])
    slv = table(spark, [(1, "B", 0), (2, "B", 0), (3, "A", 0), (5, "B", 0), (None, "B", 0)])
    assert rows(state_mismatch(src, slv, ITEM, "name")) == [(1, "A", "B", 1)]
    safe = state_mismatch(src, slv, ITEM, "name", null_safe=True)
    assert rows(safe) == [(1, "A", "B", 1), (2, None, "B", 1)]


def test_mismatch_with_a_key_repeated_on_both_sides_stays_small(spark):
    side = spark.range(30_000).select(
        F.when(F.col("id") < 10_000, 0).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("name"),
        F.lit(0).alias("qty"),
    )
    got = rows(state_mismatch(side, side, ITEM, "name"))
    assert got == [(0, "A", "B", 25_000_000), (0, "B", "A", 25_000_000)]


def test_count_diff_with_null_type_on_both_sides(spark):
    day, other = at("2024-01-05 12:00:00"), at("2024-01-06 00:00:00")
    schema = "event_type string, created_at timestamp"
    src = spark.createDataFrame([("A", day), ("A", day), (None, day), ("B", other)], schema)
    slv = spark.createDataFrame([("A", day), (None, day), ("C", day)], schema)
    got = count_diff_by(src, slv, "event_type", "2024-01-05")
    assert rows(got) == sorted(
        [("A", 2, 1, -1), (None, 1, 0, -1), (None, 0, 1, 1), ("C", 0, 1, 1)], key=repr
    )
    safe = count_diff_by(src, slv, "event_type", "2024-01-05", null_safe=True)
    assert (None, 1, 1, 0) in rows(safe)
    assert rows(event_total(src, slv, "2024-01-05")) == [(3, 3, 0, "OK")]
    assert rows(event_total(src, slv, "2024-01-06")) == [(1, 0, 1, "WARNING")]
    assert rows(event_total(src, slv, "2030-01-01")) == [(0, 0, 0, "OK")]


def test_constraints(spark):
    df = table(spark, [(1, "a", 1), (1, "b", None), (None, "zz", 3), (4, None, 3)])
    assert rows(check_pk(df, ITEM)) == [(1, 2), (None, 1)]
    assert rows(check_unique(df, "qty")) == [(3, 2)]
    assert rows(check_not_null(df, ["id", "name", "qty"])) == [("id", 1), ("name", 1), ("qty", 1)]
    assert rows(check_domain(df, "name", ["a", "b"]), "name") == [("zz",)]
    got = domain_violations(df, {"name": ["a"], "qty": [1, 3]})
    assert rows(got) == [("name", 2), ("qty", 0)]


def test_foreign_keys_with_hot_child_and_repeated_parent(spark):
    child = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("fk"))
    child = child.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS fk"))
    parent = spark.range(9_000).select((F.col("id") % 4_500).alias("key"))
    got = {r.fk: r.child_rows for r in check_fk(child, parent, ("fk", "key")).collect()}
    assert got[-1] == 3_000 and all(k == -1 or k >= 4_500 for k in got)
    assert sum(got.values()) == 3_000 + 3_000


def test_defaults_fill_currency_only(spark):
    df = spark.createDataFrame(
        [("p", None, None), ("q", "USD", None)], "payment_id string, currency string, created_at timestamp"
    )
    assert rows(apply_defaults(df, entity("payments"))) == [("p", "VND", None), ("q", "USD", None)]


def pair_of(spark, altered=False, dropped=False):
    day = at("2024-01-05 12:00:00")
    pnr = [("A", "WEB", "CREATED", day, day), ("B", "WEB", "TICKETED", day, day)]
    ev = [(1, "A", "CREATED", day), (2, "B", "TICKETED", day)]
    silver_pnr = [(*pnr[0][:2], "CANCELLED", day, day), pnr[1]] if altered else pnr
    silver_ev = ev[:1] if dropped else ev
    make = lambda name, data: table(spark, data, entity(name))
    return {
        "pnr_records": (make("pnr_records", pnr), make("pnr_records", silver_pnr)),
        "booking_events": (make("booking_events", ev), make("booking_events", silver_ev)),
    }


def test_reconciliation_report(spark):
    clean = run_reconciliation(pair_of(spark), date="2024-01-05")
    assert clean.columns == ["step", "table_name", "check_name", "value", "status", "detail"]
    assert {r.status for r in clean.collect()} == {"OK"}

    def failing(**kw):
        checks = run_reconciliation(pair_of(spark, **kw), date="2024-01-05").where("status <> 'OK'")
        return rows(checks, "table_name", "check_name", "value", "status")

    assert failing(altered=True) == [("pnr_records", "booking_status_mismatch", 1, "WARNING")]
    assert failing(dropped=True) == [
        ("booking_events", "event_total_gap", 1, "WARNING"),
        ("booking_events", "event_type_difference", -1, "WARNING"),
        ("booking_events", "row_count_difference", -1, "WARNING"),
    ]


def test_reconciliation_steps(spark):
    only = run_reconciliation(pair_of(spark), steps=["state"])
    assert {r.step for r in only.collect()} == {"state"}
    with pytest.raises(ValueError, match="unknown"):
        run_reconciliation(pair_of(spark), steps=["gold"])
    with pytest.raises(ValueError, match="date"):
        run_reconciliation(pair_of(spark))
