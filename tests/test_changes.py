import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions import as_day, differs, event_day, on_day
from cdclake.operators.changes import (
    allow_tables,
    conform,
    latest_per_key,
    null_keys,
    null_ops,
    parse_envelopes,
    route,
    split_unconvertible,
    unwrap_changes,
    with_event_date,
)
from cdclake.specs import entity
from conftest import rows
from util import ITEM, VERSIONED, at, changes


def test_topic_prefix_is_stripped_once(spark):
    df = spark.createDataFrame([("cdc.shop.dbo.payments",), ("plain",)], "topic string")
    assert rows(route(df)) == [("plain",), ("shop.dbo.payments",)]


def test_only_named_tables_pass(spark):
    df = spark.createDataFrame(
        [("shop.dbo.payments",), ("shop.dbo.other",), ("payments",), (None,)], "topic string"
    )
    assert rows(allow_tables(df, ["payments"])) == [("payments",), ("shop.dbo.payments",)]


ENVELOPE = '{"before": %s, "after": %s, "source": {"ts_ms": %d, "table": "payments"}, "op": "%s"}'
ROW = (
    '{"payment_id": "p1", "pnr_id": "A", "payment_method": "CASH", "amount": %s,'
    ' "currency": "VND", "payment_status": "SUCCESS", "created_at": 1704067199999, "updated_at": 0}'
)


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_unwrap_takes_after_or_before_and_types_the_row(spark):
    spec = entity("payments")
    sent = messages(
        spark,
        ENVELOPE % ("null", ROW % "10.5", 1, "c"),
        ENVELOPE % (ROW % "10.5", ROW % "0.1", 2, "u"),
        ENVELOPE % (ROW % "7", "null", 3, "d"),
        None,
    )
    flat = unwrap_changes(parse_envelopes(sent, spec), spec)
    got = rows(flat, "__source_ts_ms", "__op", "__deleted", F.col("amount").cast("string"), "__table")
    assert got == [
        (1, "c", "false", "10.50", "payments"),
        (2, "u", "false", "0.10", "payments"),
        (3, "d", "true", "7.00", "payments"),
    ]
    assert flat.schema["created_at"].dataType == T.TimestampType()
    assert flat.select(F.unix_millis("created_at")).first()[0] == 1704067199999


def test_tombstone_kept_on_request_has_no_key(spark):
    spec = entity("payments")
    flat = unwrap_changes(parse_envelopes(messages(spark, None), spec), spec, drop_tombstones=False)
    assert flat.count() == 1 and null_keys(flat, spec).count() == 1


def test_malformed_message_stops_the_query(spark):
    spec = entity("payments")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        parse_envelopes(messages(spark, "{oops"), spec).collect()


def test_arrival_day_is_utc_whatever_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    ms = [(1704067199999,), (1704067200000,), (None,)]
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        by_ms = spark.createDataFrame(ms, "t bigint")
        by_ts = by_ms.select(F.timestamp_millis("t").alias("t"))
        for df in (by_ms, by_ts):
            days = [r[0] for r in with_event_date(df, "t").select("event_date").collect()]
            assert days == ["2023-12-31", "2024-01-01", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_day_filter_is_half_open_and_rejects_bad_dates(spark):
    df = spark.createDataFrame(
        [(at("2024-01-05 00:00:00"),), (at("2024-01-05 23:59:59.999"),), (at("2024-01-06 00:00:00"),)],
        "t timestamp",
    )
    assert df.where(on_day(F.col("t"), "2024-01-05")).count() == 2
    assert as_day(dt.datetime(2024, 1, 5, 3)) == dt.date(2024, 1, 5)
    with pytest.raises(ValueError):
        on_day(F.col("t"), "2024-13-05")


def test_day_filter_reaches_the_scan(spark, tmp_path):
    spark.range(3).select(F.timestamp_seconds("id").alias("t")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).where(on_day(F.col("t"), "2024-01-05"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t), GreaterThanOrEqual(t" in plan


def test_event_day_accepts_local_timestamps(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-05 23:59:59' AS t")
    assert df.select(event_day(F.col("t"), df.schema["t"].dataType)).first()[0] == "2024-01-05"


def test_inequality_ignores_null_unless_asked(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, None), ("a", "a")], "x string, y string")
    assert df.where(differs(F.col("x"), F.col("y"))).count() == 1
    assert df.where(differs(F.col("x"), F.col("y"), null_safe=True)).count() == 2


def test_double_amounts_round_half_up(spark):
    df = spark.createDataFrame([("p", 0.005), ("q", 12.0)], "payment_id string, amount double")
    got = conform(df, entity("payments")).select("payment_id", F.col("amount").cast("string"))
    assert rows(got) == [("p", "0.01"), ("q", "12.00")]


def test_amount_that_does_not_fit_fails_or_is_set_aside(spark):
    df = spark.createDataFrame([("p", 1e11), ("q", 1.0), ("r", None)], "payment_id string, amount double")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        conform(df, entity("payments")).collect()
    good, bad = split_unconvertible(df, entity("payments"))
    assert rows(good, "payment_id") == [("q",), ("r",)]
    assert rows(bad) == [("p", 1e11)]


def test_conform_keeps_unknown_and_fills_absent_columns(spark):
    df = spark.createDataFrame([(1, "new", "c")], "id bigint, colour string, __op string")
    got = conform(df, ITEM)
    assert got.columns == ["id", "name", "qty", "__op", "colour"]
    assert rows(got) == [(1, None, None, "c", "new")]


def test_latest_by_time_then_code_then_values(spark):
    log = changes(
        spark,
        [
            (1, "old", 1, "c", 10),
            (1, "new", 1, "u", 20),
            (2, "same ms", 1, "c", 10),
            (2, "same ms", 2, "u", 10),
            (3, "a", 9, "u", 10),
            (3, "b", 1, "u", 10),
            (4, "gone", 1, "d", 10),
            (4, "back", 1, "c", 20),
            (5, "no time", 1, "u", None),
            (5, "timed", 1, "r", 0),
            (None, "no key", 1, "u", 1),
        ],
    )
    got = rows(latest_per_key(log, ITEM), "id", "name", "qty", "__op")
    assert got == [
        (1, "new", 1, "u"),
        (2, "same ms", 2, "u"),
        (3, "b", 1, "u"),
        (4, "back", 1, "c"),
        (5, "timed", 1, "r"),
    ]
    assert null_keys(log, ITEM).count() == 1


def test_row_version_breaks_ties_before_other_values(spark):
    log = changes(
        spark,
        [
            (1, "zz", at("2024-01-01 00:00:00"), "u", 10),
            (1, "aa", at("2024-01-02 00:00:00"), "u", 10),
            (1, "mm", None, "u", 10),
        ],
        VERSIONED,
    )
    assert rows(latest_per_key(log, VERSIONED), "name") == [("aa",)]


def test_log_sequence_decides_within_one_time(spark):
    log = changes(spark, [(1, "deleted", 1, "d", 10), (1, "again", 1, "c", 10)]).withColumn(
        "seq", F.when(F.col("__op") == "d", 1).otherwise(2)
    )
    assert rows(latest_per_key(log, ITEM), "name") == [("deleted",)]
    assert rows(latest_per_key(log, ITEM, seq_col="seq"), "name") == [("again",)]


def test_row_order_does_not_matter(spark):
    data = [(k, n, q, op, 10) for k in (1, 2) for n in ("x", "y") for q in (1, None) for op in "rcu"]
    expected = rows(latest_per_key(changes(spark, data), ITEM))
    for seed in (1, 2):
        random.Random(seed).shuffle(data)
        shuffled = changes(spark, data).repartition(5)
        assert rows(latest_per_key(shuffled, ITEM)) == expected


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    log = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("id"),
        F.lit("n").alias("name"),
        F.col("id").cast("int").alias("qty"),
        F.lit("u").alias("__op"),
        F.col("id").alias("__source_ts_ms"),
    )
    latest = latest_per_key(log, ITEM)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in below
    assert latest.count() == 40_001
    assert latest.where("id = -1").first().qty == 59_997


def test_changes_without_code_are_counted(spark):
    log = changes(spark, [(1, "a", 1, None, 1), (2, "b", 1, "u", 1)])
    assert rows(null_ops(log), "id") == [(1,)]
