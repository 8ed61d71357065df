"""Projections, predicates and change-record transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions import (
    case_flag,
    coalesce_zero,
    differs,
    on_day,
    ratio,
    to_money_total,
)
from cdclake.operators.changes import (
    allow_tables,
    conform,
    latest_per_key,
    null_ops,
    parse_envelopes,
    project,
    route,
    split_unconvertible,
    unwrap_changes,
    with_event_date,
)
from cdclake.operators.merge import merge_changes
from suite import bindings as b
from suite.lakes import plain
from suite.registry import query


@query("project", "SELECT user_id, event_id, value FROM events")
def project_columns(spark: SparkSession, sf: str) -> DataFrame:
    return project(b.change_log(spark, sf), b.USER_LOG)


@query(
    "alias",
    f"SELECT pnr_id, booking_status AS src_status, created_at AS booking_time FROM {b.PNR}",
)
def alias(spark: SparkSession, sf: str) -> DataFrame:
    return b.pnr_records(spark, sf).select(
        "pnr_id",
        F.col("booking_status").alias("src_status"),
        F.col("created_at").alias("booking_time"),
    )


@query("cast_date", "SELECT event_id, CAST(ts AS DATE) AS event_day FROM events")
def cast_date(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "events").select("event_id", F.to_date("ts").alias("event_day"))


@query(
    "cast_decimal",
    f"""SELECT booking_channel, CAST(sum(amount) AS DECIMAL(16,2)) AS total_amount
      FROM (SELECT payment_method AS booking_channel, amount FROM {b.PAYMENTS}) GROUP BY ALL""",
)
def cast_decimal(spark: SparkSession, sf: str) -> DataFrame:
    return (
        b.payments(spark, sf)
        .groupBy(F.col("payment_method").alias("booking_channel"))
        .agg(to_money_total(F.sum("amount")).alias("total_amount"))
    )


@query(
    "cast_double",
    f"""SELECT booking_channel, CAST(count(*) FILTER (booking_status = 'TICKETED') AS DOUBLE) AS ticketed
      FROM {b.PNR} GROUP BY ALL""",
)
def cast_double(spark: SparkSession, sf: str) -> DataFrame:
    return (
        b.pnr_records(spark, sf)
        .groupBy("booking_channel")
        .agg(F.count_if(F.col("booking_status") == "TICKETED").cast("double").alias("ticketed"))
    )


@query("filter_eq", f"SELECT pnr_id, amount FROM {b.PAYMENTS} WHERE payment_status = 'SUCCESS'")
def filter_eq(spark: SparkSession, sf: str) -> DataFrame:
    return (
        b.payments(spark, sf).where(F.col("payment_status") == "SUCCESS").select("pnr_id", "amount")
    )


_ERR = "(SELECT event_id, nullif(event_type, 'click') AS a, nullif(event_type, 'view') AS b FROM events)"


@query("filter_neq", f"SELECT event_id, a, b FROM {_ERR} WHERE a <> b")
def filter_neq(spark: SparkSession, sf: str) -> DataFrame:
    """NULL against a value is not a difference."""
    return _two_columns(spark, sf).where(differs(F.col("a"), F.col("b")))


@query("filter_neq_null_safe", f"SELECT event_id, a, b FROM {_ERR} WHERE a IS DISTINCT FROM b")
def filter_neq_null_safe(spark: SparkSession, sf: str) -> DataFrame:
    return _two_columns(spark, sf).where(differs(F.col("a"), F.col("b"), null_safe=True))


def _two_columns(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return b.table(spark, sf, "events").select(
        "event_id",
        F.nullif(kind, F.lit("click")).alias("a"),
        F.nullif(kind, F.lit("view")).alias("b"),
    )


@query(
    "filter_date_param",
    f"SELECT * FROM {b.EVENTS} WHERE CAST(created_at AS DATE) = DATE '{b.EVENT_DAY}'",
)
def filter_date_param(spark: SparkSession, sf: str) -> DataFrame:
    return b.booking_events(spark, sf).where(on_day(F.col("created_at"), b.EVENT_DAY))


@query(
    "case_flag",
    f"""SELECT pnr_id, CASE WHEN booking_status = 'CANCELLED' THEN 1 ELSE 0 END AS cancelled
      FROM {b.PNR}""",
)
def flag(spark: SparkSession, sf: str) -> DataFrame:
    return b.pnr_records(spark, sf).select(
        "pnr_id", case_flag(F.col("booking_status") == "CANCELLED").alias("cancelled")
    )


@query(
    "coalesce",
    """SELECT o_orderkey, coalesce(n, 0) AS segments FROM orders LEFT JOIN (SELECT l_orderkey,
      count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
)
def coalesce(spark: SparkSession, sf: str) -> DataFrame:
    n = (
        b.table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("n"))
    )
    return (
        b.table(spark, sf, "orders")
        .join(n, "o_orderkey", "left")
        .select("o_orderkey", coalesce_zero(F.col("n")).alias("segments"))
    )


@query(
    "literal_column",
    f"SELECT 'pnr_records' AS table_name, count(*) AS n_rows FROM {b.PNR}",
)
def literal_column(spark: SparkSession, sf: str) -> DataFrame:
    counted = b.pnr_records(spark, sf).agg(F.count("*").alias("n_rows"))
    return counted.select(F.lit("pnr_records").alias("table_name"), "n_rows")


@query(
    "arith",
    f"""SELECT booking_channel, ticketed - created AS gap, abs(ticketed - created) AS abs_gap,
      CAST(ticketed AS DOUBLE) / n AS share FROM (SELECT booking_channel, count(*) AS n,
      count(*) FILTER (booking_status = 'TICKETED') AS ticketed,
      count(*) FILTER (booking_status = 'CREATED') AS created FROM {b.PNR} GROUP BY ALL)""",
)
def arith(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("booking_status")
    counts = (
        b.pnr_records(spark, sf)
        .groupBy("booking_channel")
        .agg(
            F.count("*").alias("n"),
            F.count_if(status == "TICKETED").alias("ticketed"),
            F.count_if(status == "CREATED").alias("created"),
        )
    )
    gap = F.col("ticketed") - F.col("created")
    return counts.select(
        "booking_channel",
        gap.alias("gap"),
        F.abs(gap).alias("abs_gap"),
        ratio(F.col("ticketed"), F.col("n")).alias("share"),
    )


@query("unwrap_change", f"SELECT * FROM {b.FLAT_SQL}")
def unwrap(spark: SparkSession, sf: str) -> DataFrame:
    flat = unwrap_changes(b.envelopes(spark, sf), b.EVENT_SPEC)
    return b.flat_view(with_event_date(flat, "timestamp"))


@query(
    "drop_tombstones",
    f"SELECT __op, count(*) AS n_rows, count(DISTINCT event_id) AS n_keys FROM {b.FLAT_SQL} GROUP BY ALL",
)
def tombstones(spark: SparkSession, sf: str) -> DataFrame:
    """Each delete is followed by an empty message for its key; those messages vanish."""
    sent = b.envelopes(spark, sf)
    empty = sent.where("op = 'd'").select(
        *[
            F.lit(None).cast(f.dataType).alias(f.name)
            if f.name in ("before", "after", "source", "op", "ts_ms")
            else F.col(f.name)
            for f in sent.schema
        ]
    )
    flat = unwrap_changes(sent.unionByName(empty), b.EVENT_SPEC)
    return flat.groupBy("__op").agg(
        F.count("*").alias("n_rows"), F.countDistinct("event_id").alias("n_keys")
    )


@query(
    "stamp_event_date",
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS event_date FROM events",
)
def stamp(spark: SparkSession, sf: str) -> DataFrame:
    return with_event_date(b.table(spark, sf, "events"), "ts").select("event_id", "event_date")


_TOPIC = "'cdc.shop.dbo.' || event_type"


@query(
    "route_table",
    f"SELECT event_id, regexp_replace({_TOPIC}, '^[^.]+\\.(.*)', '\\1') AS topic FROM events",
)
def route_topics(spark: SparkSession, sf: str) -> DataFrame:
    return route(_topics(spark, sf))


@query(
    "allow_tables",
    f"SELECT event_id, {_TOPIC} AS topic FROM events WHERE event_type IN ('click', 'view')",
)
def allow(spark: SparkSession, sf: str) -> DataFrame:
    return allow_tables(_topics(spark, sf), ["click", "view"])


def _topics(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("cdc.shop.dbo."), "event_type").alias("topic")
    )


@query(
    "narrow_amount",
    "SELECT CAST(o_orderkey AS VARCHAR) AS payment_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount FROM orders",
)
def narrow_amount(spark: SparkSession, sf: str) -> DataFrame:
    return conform(_double_payments(spark, sf), b.SPECS["payments"]).select("payment_id", "amount")


@query(
    "quarantine_amount",
    "SELECT CAST(o_orderkey AS VARCHAR) AS payment_id, o_totalprice * o_custkey * 100 AS amount "
    "FROM orders WHERE round(o_totalprice * o_custkey * 100, 2) >= 1e10",
)
def quarantine_amount(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts that do not fit DECIMAL(12,2) are set aside with their original value."""
    raw = b.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("payment_id"),
        (F.col("o_totalprice") * F.col("o_custkey") * 100).alias("amount"),
    )
    _, misfits = split_unconvertible(raw, b.SPECS["payments"])
    return misfits


def _double_payments(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("payment_id"),
        F.col("o_totalprice").alias("amount"),
    )


def _with_null_ops(log: DataFrame) -> DataFrame:
    return log.withColumn("__op", F.nullif("__op", F.lit("r")))


@query(
    "skip_null_op",
    f"""SELECT user_id, event_id, value FROM (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER
      (PARTITION BY user_id ORDER BY __source_ts_ms DESC) AS rn
      FROM (SELECT * FROM {b.change_log_sql()} WHERE __op <> 'r')) WHERE rn = 1)
      WHERE __op <> 'd'""",
)
def skip_null_op(spark: SparkSession, sf: str) -> DataFrame:
    """Changes without a code are ignored: the latest that has one decides."""
    log = _with_null_ops(b.change_log(spark, sf))
    nothing = spark.createDataFrame([], b.USER_LOG.schema)
    return merge_changes(nothing, log, b.USER_LOG)


@query(
    "count_null_ops",
    "SELECT strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS n_rows FROM events "
    "WHERE event_type = 'view' GROUP BY ALL",
)
def count_null_ops(spark: SparkSession, sf: str) -> DataFrame:
    log = _with_null_ops(b.change_log(spark, sf))
    return null_ops(log).groupBy("event_date").agg(F.count("*").alias("n_rows"))


@query("parse_envelopes", f"SELECT * FROM {b.FLAT_SQL}")
def parse(spark: SparkSession, sf: str) -> DataFrame:
    """The same changes as JSON messages."""
    sent = b.envelopes(spark, sf)
    payload = F.to_json(F.struct("before", "after", "source", "op", "ts_ms"))
    messages = sent.select("topic", "timestamp", payload.cast("binary").alias("value"))
    flat = unwrap_changes(parse_envelopes(messages, b.EVENT_SPEC), b.EVENT_SPEC)
    return b.flat_view(with_event_date(flat, "timestamp"))
