"""Entities, change logs and reconciliation pairs derived from the test tables.

Every function has a SQL twin (upper-case constants) with the same columns, used by the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.operators.reconcile import union_all
from cdclake.specs import ENTITIES, TableSpec, parse_schema

SPECS = {name: spec.with_long_ids() for name, spec in ENTITIES.items()}

# Arrival days of the two loads in the end-to-end feed, and their start in epoch milliseconds.
DAY_1, DAY_2 = "2024-01-01", "2024-01-02"
MS_1, MS_2 = 1_704_067_200_000, 1_704_153_600_000

EVENT_DAY = "2024-01-05"
CUT = "2024-01-16"

MONEY = T.DecimalType(12, 2)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- entities -----------------------------------------------------------------------------------


def _recode(column: str, codes: dict[str, str]):
    chain = None
    for code, value in codes.items():
        hit = F.col(column) == code
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain


def recode_sql(column: str, codes: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{c}' THEN '{v}'" for c, v in codes.items()) + " END"


BOOKING = {"F": "TICKETED", "O": "CREATED", "P": "CANCELLED"}
PAYMENT = {"F": "SUCCESS", "O": "PENDING", "P": "FAILED"}


def pnr_records(spark: SparkSession, sf: str) -> DataFrame:
    return _as_pnr(table(spark, sf, "orders"), "o_orderstatus")


def _as_pnr(orders: DataFrame, status: str, *keep: str) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").cast("string").alias("pnr_id"),
        F.col("o_orderpriority").alias("booking_channel"),
        _recode(status, BOOKING).alias("booking_status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        *keep,
    )


PNR = f"""(SELECT CAST(o_orderkey AS VARCHAR) AS pnr_id, o_orderpriority AS booking_channel,
  {recode_sql('o_orderstatus', BOOKING)} AS booking_status,
  o_orderdate AS created_at, o_orderdate AS updated_at FROM orders)"""


def payments(spark: SparkSession, sf: str) -> DataFrame:
    return _as_payment(table(spark, sf, "orders"), "o_orderstatus")


def _as_payment(orders: DataFrame, status: str, *keep: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return orders.select(
        key.alias("payment_id"),
        key.alias("pnr_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.lit("VND").alias("currency"),
        _recode(status, PAYMENT).alias("payment_status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        *keep,
    )


PAYMENTS = f"""(SELECT CAST(o_orderkey AS VARCHAR) AS payment_id,
  CAST(o_orderkey AS VARCHAR) AS pnr_id, o_orderpriority AS payment_method,
  CAST(o_totalprice AS DECIMAL(12,2)) AS amount, 'VND' AS currency,
  {recode_sql('o_orderstatus', PAYMENT)} AS payment_status,
  o_orderdate AS created_at, o_orderdate AS updated_at FROM orders)"""


def flight_segments(spark: SparkSession, sf: str) -> DataFrame:
    """One segment per line; the route runs from the supplier's to the customer's nation."""
    # Each step joins a base table, whose size Spark knows, to the larger side. Nations get their names last, so that
    # lines and bookings are moved with numbers.
    nations = table(spark, sf, "nation")
    origin = nations.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin"))
    dest = nations.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("dest"))
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    bookings = (
        table(spark, sf, "orders")
        .select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        .join(customers, "o_custkey")
        .drop("o_custkey")
    )
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_shipdate"
    )
    return (
        lines.join(suppliers, "l_suppkey")
        .drop("l_suppkey")
        .join(bookings, "l_orderkey")
        .join(origin, "s_nationkey")
        .join(dest, "c_nationkey")
        .select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("segment_id"),
            F.col("l_orderkey").cast("string").alias("pnr_id"),
            F.col("origin").alias("origin_airport"),
            F.col("dest").alias("dest_airport"),
            F.to_date("l_shipdate").alias("flight_date"),
            F.col("l_returnflag").alias("airline_code"),
            F.col("l_linenumber").cast("string").alias("flight_number"),
            F.col("l_shipdate").alias("created_at"),
            F.col("l_shipdate").alias("updated_at"),
        )
    )


SEGMENTS = """(SELECT l_orderkey * 8 + l_linenumber AS segment_id,
  CAST(l_orderkey AS VARCHAR) AS pnr_id, ns.n_name AS origin_airport, nc.n_name AS dest_airport,
  CAST(l_shipdate AS DATE) AS flight_date, l_returnflag AS airline_code,
  CAST(l_linenumber AS VARCHAR) AS flight_number, l_shipdate AS created_at, l_shipdate AS updated_at
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation nc ON nc.n_nationkey = c_nationkey JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ns ON ns.n_nationkey = s_nationkey)"""


def passengers(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    no_time = F.lit(None).cast(T.TimestampNTZType())
    return table(spark, sf, "customer").select(
        key.alias("passenger_id"),
        key.cast("string").alias("pnr_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.lit(None).cast("string").alias("email"),
        F.col("c_nationkey").cast("string").alias("passport_number"),
        no_time.alias("created_at"),
        no_time.alias("updated_at"),
    )


PASSENGERS = """(SELECT c_custkey AS passenger_id, CAST(c_custkey AS VARCHAR) AS pnr_id,
  c_name AS first_name, c_mktsegment AS last_name, CAST(NULL AS VARCHAR) AS email,
  CAST(c_nationkey AS VARCHAR) AS passport_number, CAST(NULL AS TIMESTAMP) AS created_at,
  CAST(NULL AS TIMESTAMP) AS updated_at FROM customer)"""


def tickets(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    no_time = F.lit(None).cast(T.TimestampNTZType())
    return table(spark, sf, "customer").select(
        F.concat(F.lit("738"), F.lpad(key.cast("string"), 10, "0")).alias("ticket_number"),
        key.alias("passenger_id"),
        F.col("c_mktsegment").alias("fare_class"),
        F.lit("ISSUED").alias("ticket_status"),
        no_time.alias("created_at"),
        no_time.alias("updated_at"),
    )


TICKETS = """(SELECT '738' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS ticket_number,
  c_custkey AS passenger_id, c_mktsegment AS fare_class, 'ISSUED' AS ticket_status,
  CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at FROM customer)"""


def booking_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("pnr_id"),
        "event_type",
        F.col("ts").alias("created_at"),
    )


EVENTS = """(SELECT event_id, CAST(user_id AS VARCHAR) AS pnr_id, event_type,
  ts AS created_at FROM events)"""

SOURCES = {
    "pnr_records": (pnr_records, PNR),
    "passengers": (passengers, PASSENGERS),
    "flight_segments": (flight_segments, SEGMENTS),
    "tickets": (tickets, TICKETS),
    "payments": (payments, PAYMENTS),
    "booking_events": (booking_events, EVENTS),
}

# -- a change log per user ------------------------------------------------------------------------

USER_LOG = TableSpec(
    name="user_events",
    schema=parse_schema("user_id BIGINT!, event_id BIGINT, value DOUBLE"),
    pk="user_id",
)
OPS = {"signup": "c", "error": "d", "view": "r"}

OP_SQL = "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' WHEN 'view' THEN 'r' ELSE 'u' END"
RANK_SQL = "CASE __op WHEN 'r' THEN 0 WHEN 'c' THEN 1 WHEN 'u' THEN 2 WHEN 'd' THEN 3 END"


def op_code():
    return F.coalesce(_recode("event_type", OPS), F.lit("u"))


def epoch_ms(ts):
    return F.unix_millis(ts.cast("timestamp"))


def change_log(spark: SparkSession, sf: str, by_day: bool = False) -> DataFrame:
    """Events as changes of their user; ``by_day`` cuts source times to the day, so keys tie."""
    ts = F.col("ts")
    source_time = F.to_date(ts).cast(T.TimestampNTZType()) if by_day else ts
    return table(spark, sf, "events").select(
        "user_id",
        "event_id",
        "value",
        F.when(op_code() == "d", "true").otherwise("false").alias("__deleted"),
        op_code().alias("__op"),
        F.lit("user_events").alias("__table"),
        epoch_ms(source_time).alias("__source_ts_ms"),
        F.to_date(ts).cast("string").alias("event_date"),
    )


def change_log_sql(by_day: bool = False) -> str:
    ts = "CAST(CAST(ts AS DATE) AS TIMESTAMP)" if by_day else "ts"
    return f"""(SELECT user_id, event_id, value,
      CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END AS __deleted,
      {OP_SQL} AS __op, 'user_events' AS __table, epoch_us({ts}) // 1000 AS __source_ts_ms,
      strftime(ts, '%Y-%m-%d') AS event_date FROM events)"""


def latest_sql(by_day: bool = False) -> str:
    return f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY __source_ts_ms DESC, {RANK_SQL} DESC, event_id DESC) AS rn
      FROM {change_log_sql(by_day)}) WHERE rn = 1)"""


# -- envelopes ------------------------------------------------------------------------------------

EVENT_SPEC = SPECS["booking_events"]


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a change envelope of booking_events, as a capture tool would send it."""
    row = F.struct(
        "event_id",
        F.col("user_id").cast("string").alias("pnr_id"),
        "event_type",
        epoch_ms(F.col("ts")).alias("created_at"),
    )
    deleted = op_code() == "d"
    return table(spark, sf, "events").select(
        F.when(deleted, row).alias("before"),
        F.when(~deleted, row).alias("after"),
        F.struct(
            epoch_ms(F.col("ts")).alias("ts_ms"), F.lit("booking_events").alias("table")
        ).alias("source"),
        op_code().alias("op"),
        epoch_ms(F.col("ts")).alias("ts_ms"),
        F.lit("cdc.shop.dbo.booking_events").alias("topic"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


FLAT_SQL = f"""(SELECT event_id, CAST(user_id AS VARCHAR) AS pnr_id, event_type,
  epoch_us(ts) // 1000 AS created_ms, CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END AS __deleted,
  {OP_SQL} AS __op, 'booking_events' AS __table, epoch_us(ts) // 1000 AS __source_ts_ms,
  strftime(ts, '%Y-%m-%d') AS event_date FROM events)"""


def flat_view(changes: DataFrame) -> DataFrame:
    """Flattened booking_events changes with times as epoch millis, as in ``FLAT_SQL``."""
    return changes.select(
        "event_id",
        "pnr_id",
        "event_type",
        F.unix_millis("created_at").alias("created_ms"),
        "__deleted",
        "__op",
        "__table",
        "__source_ts_ms",
        "event_date",
    )


def change_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a flattened change of booking_events, at its own time."""
    return booking_events(spark, sf).select(
        "event_id",
        "pnr_id",
        "event_type",
        F.col("created_at").cast("timestamp").alias("created_at"),
        op_code().alias("__op"),
        epoch_ms(F.col("created_at")).alias("__source_ts_ms"),
    )


def as_messages(changes: DataFrame, spec: TableSpec, *keep: str) -> DataFrame:
    """Flattened changes as the broker's messages: JSON envelopes with topic, place and arrival time."""

    def wire(f):
        if isinstance(f.dataType, T.TimestampType):
            return epoch_ms(F.col(f.name))
        if isinstance(f.dataType, T.DateType):
            return F.unix_date(f.name)
        return F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name)

    row = F.struct(*[wire(f).alias(f.name) for f in spec.schema])
    deleted = F.col("__op") == "d"
    ts = F.col("__source_ts_ms")
    envelope = F.struct(
        F.when(deleted, row).alias("before"),
        F.when(~deleted, row).alias("after"),
        F.struct(ts.alias("ts_ms"), F.lit(spec.name).alias("table")).alias("source"),
        F.col("__op").alias("op"),
        ts.alias("ts_ms"),
    )
    place = F.pmod(F.xxhash64(F.col(spec.pk)), F.lit(1 << 40))
    return changes.select(
        F.lit(f"cdc.shop.dbo.{spec.name}").alias("topic"),
        (place % 3).cast("int").alias("partition"),
        place.alias("offset"),
        F.timestamp_millis(ts).alias("timestamp"),
        F.to_json(envelope).alias("value"),
        *keep,
    )


# -- the end-to-end feed ----------------------------------------------------------------------------
# Day 1 is a snapshot of every table. On day 2 bookings and payments take the status their lines
# imply, bookings without lines are deleted, returned segments are deleted, customers in debt lose
# their ticket and record while the others get an email, and error events are deleted.


def line_status(spark: SparkSession, sf: str) -> DataFrame:
    """(o_orderkey, implied): F or O when all lines of the order agree, else P."""
    lines = table(spark, sf, "lineitem")
    lo, hi = F.min("l_linestatus"), F.max("l_linestatus")
    return (
        lines.groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(lo.alias("lo"), hi.alias("hi"))
        .select("o_orderkey", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise("P").alias("implied"))
    )


IMPLIED = """(SELECT orders.*, implied FROM orders LEFT JOIN (SELECT l_orderkey,
  CASE WHEN min(l_linestatus) = max(l_linestatus) THEN min(l_linestatus) ELSE 'P' END AS implied
  FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""


def _changes(rows: DataFrame, spec: TableSpec, op, day: str, ms: int) -> DataFrame:
    op = F.lit(op) if isinstance(op, str) else op
    return rows.select(
        *spec.columns,
        F.when(op == "d", "true").otherwise("false").alias("__deleted"),
        op.alias("__op"),
        F.lit(spec.name).alias("__table"),
        F.lit(ms).cast("long").alias("__source_ts_ms"),
        F.lit(day).alias("event_date"),
    )


def orders_now(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the status that their lines imply, NULL for those without lines."""
    return table(spark, sf, "orders").join(line_status(spark, sf), "o_orderkey", "left")


def _both_days(rows: DataFrame, again) -> DataFrame:
    """Every row on day 1, and once more on day 2 where ``again`` holds, told apart by ``later``: one pass for both."""
    first, both = F.array(F.lit(False)), F.array(F.lit(False), F.lit(True))
    return rows.select("*", F.explode(F.when(again, both).otherwise(first)).alias("later"))


def _dated(rows: DataFrame, spec: TableSpec, op) -> DataFrame:
    """Rows of both days as changes: a snapshot's on day 1, with ``op`` on day 2."""
    later = F.col("later")
    code = F.when(later, op).otherwise("r")
    return rows.select(
        *spec.columns,
        F.when(code == "d", "true").otherwise("false").alias("__deleted"),
        code.alias("__op"),
        F.lit(spec.name).alias("__table"),
        F.when(later, F.lit(MS_2)).otherwise(F.lit(MS_1)).cast("long").alias("__source_ts_ms"),
        F.when(later, DAY_2).otherwise(DAY_1).alias("event_date"),
    )


def feed(spark: SparkSession, sf: str, name: str, now: DataFrame | None = None) -> DataFrame:
    """All changes of one entity over both days. ``now`` is :func:`orders_now`, where a caller has it at hand."""
    spec = SPECS[name]
    if name in ("pnr_records", "payments"):
        as_entity = _as_pnr if name == "pnr_records" else _as_payment
        # Every order has a row for its booking on day 2, only those with lines one for the payment.
        again = F.lit(True) if name == "pnr_records" else F.col("implied").isNotNull()
        both = _both_days(orders_now(spark, sf) if now is None else now, again)
        both = both.withColumn("status", F.when(F.col("later"), F.col("implied")).otherwise(F.col("o_orderstatus")))
        gone = F.col("booking_status").isNull() if name == "pnr_records" else F.lit(False)
        return _dated(as_entity(both, "status", "later"), spec, F.when(gone, "d").otherwise("u"))
    if name == "flight_segments":
        return _dated(_both_days(flight_segments(spark, sf), F.col("airline_code") == "R"), spec, F.lit("d"))
    snapshot = _changes(SOURCES[name][0](spark, sf), spec, "r", DAY_1, MS_1)
    if name == "booking_events":
        rows = booking_events(spark, sf).where(F.col("event_type") == "error")
        op = "d"
    else:
        in_debt = table(spark, sf, "customer").select(
            F.col("c_custkey").alias("passenger_id"), (F.col("c_acctbal") < 0).alias("in_debt")
        )
        rows = SOURCES[name][0](spark, sf).join(in_debt, "passenger_id")
        if name == "tickets":
            rows, op = rows.where("in_debt"), "d"
        else:
            email = F.concat(F.col("pnr_id"), F.lit("@example.com"))
            rows = rows.withColumn("email", F.when(~F.col("in_debt"), email))
            op = F.when(F.col("in_debt"), "d").otherwise("u")
    return union_all([snapshot, _changes(rows, spec, op, DAY_2, MS_2)])


SILVER = {
    "pnr_records": f"""(SELECT CAST(o_orderkey AS VARCHAR) AS pnr_id,
      o_orderpriority AS booking_channel, {recode_sql('implied', BOOKING)} AS booking_status,
      o_orderdate AS created_at, o_orderdate AS updated_at FROM {IMPLIED}
      WHERE implied IS NOT NULL)""",
    "passengers": """(SELECT c_custkey AS passenger_id, CAST(c_custkey AS VARCHAR) AS pnr_id,
      c_name AS first_name, c_mktsegment AS last_name,
      CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
      CAST(c_nationkey AS VARCHAR) AS passport_number FROM customer WHERE c_acctbal >= 0)""",
    "flight_segments": f"""(SELECT * EXCLUDE (rn, returned) FROM (SELECT *,
      row_number() OVER (PARTITION BY segment_id ORDER BY updated_at DESC, pnr_id DESC,
        origin_airport DESC, dest_airport DESC, airline_code DESC, flight_number DESC) AS rn,
      bool_or(airline_code = 'R') OVER (PARTITION BY segment_id) AS returned
      FROM {SEGMENTS}) WHERE rn = 1 AND NOT returned)""",
    "tickets": """(SELECT '738' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS ticket_number,
      c_custkey AS passenger_id, c_mktsegment AS fare_class, 'ISSUED' AS ticket_status
      FROM customer WHERE c_acctbal >= 0)""",
    "payments": f"""(SELECT CAST(o_orderkey AS VARCHAR) AS payment_id,
      CAST(o_orderkey AS VARCHAR) AS pnr_id, o_orderpriority AS payment_method,
      CAST(o_totalprice AS DECIMAL(12,2)) AS amount, 'VND' AS currency,
      {recode_sql("coalesce(implied, o_orderstatus)", PAYMENT)} AS payment_status,
      o_orderdate AS created_at, o_orderdate AS updated_at FROM {IMPLIED})""",
    "booking_events": """(SELECT event_id, CAST(user_id AS VARCHAR) AS pnr_id, event_type,
      ts AS created_at FROM events WHERE event_type <> 'error')""",
}


def row_text(spec: TableSpec, millis: str = "epoch_us({}) // 1000") -> str:
    """SQL for all columns of a row as one text, times as epoch milliseconds by the dialect's expression."""

    def text(f):
        if isinstance(f.dataType, T.TimestampType):
            return f"CAST({millis.format(f.name)} AS STRING)"
        return f"CAST({f.name} AS STRING)"

    return "concat_ws('|', " + ", ".join(f"coalesce({text(f)}, '-')" for f in spec.schema) + ")"


# How many changes each table's feed holds, by day.
FEED_COUNTS = {
    "pnr_records": ("orders", "orders"),
    "passengers": ("customer", "customer"),
    "flight_segments": (SEGMENTS, f"(SELECT * FROM {SEGMENTS} WHERE airline_code = 'R')"),
    "tickets": ("customer", "(SELECT * FROM customer WHERE c_acctbal < 0)"),
    "payments": ("orders", f"(SELECT * FROM {IMPLIED} WHERE implied IS NOT NULL)"),
    "booking_events": ("events", "(SELECT * FROM events WHERE event_type = 'error')"),
}
