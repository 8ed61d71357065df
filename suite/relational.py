"""Joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions import case_flag, coalesce_zero, on_day, ratio
from cdclake.operators import marts
from cdclake.operators.changes import latest_per_key
from cdclake.operators.merge import as_state, current_rows, merge_changes, merge_state
from cdclake.operators.reconcile import (
    count_diff_by,
    count_reconciliation,
    duplicate_summary,
    duplicates,
    event_total,
    pk_duplicates,
    sample_violations,
    state_mismatch,
    union_all,
)
from cdclake.operators.sketches import distinct_in_range, distinct_sketches, merge_sketches, relative_error
from cdclake.sources.lake import cluster_for_write
from suite import bindings as b
from suite import jobs
from suite.lakes import fresh_dir
from suite.registry import query

# -- joins ----------------------------------------------------------------------------------------


@query(
    "inner_equi_multi",
    """SELECT l_orderkey, l_linenumber, l_shipdate, n, c.amount FROM lineitem
      JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON k = l_orderkey
      JOIN (SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(16,2)) AS amount
        FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderkey) c ON o_orderkey = l_orderkey""",
)
def inner_equi_multi(spark: SparkSession, sf: str) -> DataFrame:
    lines = b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    n = lines.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    paid = (
        b.table(spark, sf, "orders")
        .where("o_orderstatus = 'F'")
        .groupBy(F.col("o_orderkey").alias("l_orderkey"))
        .agg(F.sum(F.col("o_totalprice").cast(b.MONEY)).cast("decimal(16,2)").alias("amount"))
    )
    return lines.join(n.join(paid, "l_orderkey"), "l_orderkey")


@query("inner_equi_residual", jobs.mismatch_sql("payments", "payment_id", "payment_status"))
def inner_equi_residual(spark: SparkSession, sf: str) -> DataFrame:
    source, silver = jobs.pairs(spark, sf)["payments"]
    return state_mismatch(source, silver, b.SPECS["payments"])


@query("state_mismatch", jobs.mismatch_sql("pnr_records", "pnr_id", "booking_status"))
def pnr_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    source, silver = jobs.pairs(spark, sf)["pnr_records"]
    return state_mismatch(source, silver, b.SPECS["pnr_records"])


@query(
    "state_mismatch_repeated_keys",
    """SELECT a.l_orderkey, a.l_linestatus AS src_status, c.o_orderstatus AS target_status,
      count(*) AS pair_count FROM lineitem a JOIN orders c ON o_orderkey = l_orderkey
      WHERE a.l_linestatus <> c.o_orderstatus GROUP BY ALL""",
)
def repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Many source rows per key: one output row per status pair, counted."""
    spec = b.TableSpec("lines", b.parse_schema("l_orderkey BIGINT!, status STRING"), "l_orderkey")
    lines = b.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linestatus").alias("status"))
    orders = b.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("status")
    )
    return state_mismatch(lines, orders, spec, "status")


@query("full_outer_compare", jobs.EVENT_DIFF)
def full_outer_compare(spark: SparkSession, sf: str) -> DataFrame:
    source, silver = jobs.pairs(spark, sf)["booking_events"]
    return count_diff_by(source, silver, "event_type", b.EVENT_DAY)


_SEGMENTS = "(SELECT nullif(c_mktsegment, 'BUILDING') AS segment, c_acctbal >= 0 AS solvent FROM customer)"


@query(
    "count_diff_by",
    f"""SELECT segment, count(*) AS source_count, count(*) FILTER (solvent) AS silver_count,
      count(*) FILTER (solvent) - count(*) AS difference
      FROM {_SEGMENTS} WHERE segment IS NOT NULL GROUP BY segment
      UNION ALL SELECT NULL, count(*), 0, -count(*) FROM {_SEGMENTS} WHERE segment IS NULL
      UNION ALL SELECT NULL, 0, count(*), count(*) FROM {_SEGMENTS} WHERE segment IS NULL AND solvent""",
)
def diff_with_null_key(spark: SparkSession, sf: str) -> DataFrame:
    """A NULL key gives one row per side."""
    segment = F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    customers = b.table(spark, sf, "customer").select(segment, "c_acctbal")
    return count_diff_by(customers, customers.where("c_acctbal >= 0"), "segment")


@query("merge_changes", f"SELECT user_id, event_id, value FROM {b.latest_sql()} WHERE __op <> 'd'")
def merge_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Merging the second half of the log into the fold of the first equals one fold."""
    log = b.change_log(spark, sf)
    nothing = spark.createDataFrame([], b.USER_LOG.schema)
    target = merge_changes(nothing, log.where(F.col("event_date") < b.CUT), b.USER_LOG)
    return merge_changes(target, log.where(F.col("event_date") >= b.CUT), b.USER_LOG)


@query("merge_tied", f"SELECT user_id, event_id, value FROM {b.latest_sql(True)} WHERE __op <> 'd'")
def merge_tied(spark: SparkSession, sf: str) -> DataFrame:
    log = b.change_log(spark, sf, by_day=True)
    return merge_changes(spark.createDataFrame([], b.USER_LOG.schema), log, b.USER_LOG)


@query("stale_guard", f"SELECT user_id, event_id, value FROM {b.latest_sql(True)} WHERE __op <> 'd'")
def stale_guard(spark: SparkSession, sf: str) -> DataFrame:
    """The older half of a log full of ties arrives last and must not win."""
    log = b.change_log(spark, sf, by_day=True)
    newer = as_state(latest_per_key(log.where(F.col("event_date") >= b.CUT), b.USER_LOG), b.USER_LOG)
    state = merge_state(newer, log.where(F.col("event_date") < b.CUT), b.USER_LOG)
    return current_rows(state, b.USER_LOG)


@query("scalar_subquery", jobs.COUNTS)
def scalar_subquery(spark: SparkSession, sf: str) -> DataFrame:
    return count_reconciliation(jobs.pairs(spark, sf))


# -- aggregates -------------------------------------------------------------------------------------


@query("global_count", "SELECT count(*) AS n_rows FROM lineitem")
def global_count(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "lineitem").agg(F.count("*").alias("n_rows"))


@query("group_count", "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey")
def group_count(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_rows"))


@query(
    "sum_decimal",
    f"""SELECT pnr_id, CAST(sum(amount) AS DECIMAL(22,2)) AS total_amount FROM {b.PAYMENTS}
      GROUP BY pnr_id""",
)
def sum_decimal(spark: SparkSession, sf: str) -> DataFrame:
    return b.payments(spark, sf).groupBy("pnr_id").agg(F.sum("amount").alias("total_amount"))


@query(
    "conditional_sum",
    f"""SELECT booking_channel, CAST(sum(CASE WHEN booking_status = 'CANCELLED' THEN 1 ELSE 0 END)
      AS BIGINT) AS cancelled FROM {b.PNR} GROUP BY ALL""",
)
def conditional_sum(spark: SparkSession, sf: str) -> DataFrame:
    flag = case_flag(F.col("booking_status") == "CANCELLED")
    return b.pnr_records(spark, sf).groupBy("booking_channel").agg(F.sum(flag).alias("cancelled"))


@query(
    "ratio",
    """SELECT o_custkey, CAST(count(*) FILTER (o_orderstatus = 'P') AS DOUBLE) / count(*) AS share
      FROM orders GROUP BY o_custkey""",
)
def ratio_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    flag = case_flag(F.col("o_orderstatus") == "P")
    return (
        b.table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(ratio(F.sum(flag), F.count("*")).alias("share"))
    )


@query(
    "count_distinct",
    """SELECT CAST(l_shipdate AS DATE) AS ship_day, count(DISTINCT l_orderkey) AS bookings
      FROM lineitem GROUP BY ALL""",
)
def count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return (
        b.table(spark, sf, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("ship_day"))
        .agg(F.countDistinct("l_orderkey").alias("bookings"))
    )


@query("revenue_by_route", jobs.revenue_sql(b.SEGMENTS, b.PAYMENTS))
def revenue(spark: SparkSession, sf: str) -> DataFrame:
    return marts.revenue_by_route(b.flight_segments(spark, sf), b.payments(spark, sf))


@query("daily_booking_summary", jobs.summary_sql(b.PNR))
def booking_summary(spark: SparkSession, sf: str) -> DataFrame:
    return marts.daily_booking_summary(b.pnr_records(spark, sf))


@query("daily_cancellation_rate", jobs.cancellation_sql(b.PNR))
def cancellation_rate(spark: SparkSession, sf: str) -> DataFrame:
    return marts.daily_cancellation_rate(b.pnr_records(spark, sf))


@query("payment_status_summary", jobs.payment_sql(b.PAYMENTS))
def payment_summary(spark: SparkSession, sf: str) -> DataFrame:
    return marts.payment_status_summary(b.payments(spark, sf))


@query("count_reconciliation", jobs.COUNTS)
def counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_reconciliation(jobs.pairs(spark, sf))


@query(
    "having_duplicates",
    """SELECT l_orderkey, l_linenumber, count(*) AS occurrence FROM lineitem
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def having_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return duplicates(b.table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "pk_duplicates",
    f"""SELECT segment_id, count(*) AS occurrence FROM {b.SEGMENTS} GROUP BY segment_id
      HAVING count(*) > 1""",
)
def segment_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return pk_duplicates(b.flight_segments(spark, sf), b.SPECS["flight_segments"])


_SOURCE_SQL = {name: sql for name, (_, sql) in b.SOURCES.items()}


def _source_tables(spark: SparkSession, sf: str):
    return {name: (read(spark, sf), b.SPECS[name]) for name, (read, _) in b.SOURCES.items()}


@query("duplicate_summary", jobs.DUPLICATED.format(**_SOURCE_SQL))
def duplicated_by_table(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_summary(_source_tables(spark, sf))


@query(
    "duplicate_total",
    f"""SELECT n AS duplicated_keys, CASE WHEN n = 0 THEN 'OK' ELSE 'ERROR' END AS status
      FROM (SELECT CAST(sum(duplicated_keys) AS BIGINT) AS n
      FROM ({jobs.DUPLICATED.format(**_SOURCE_SQL)}))""",
)
def duplicate_total(spark: SparkSession, sf: str) -> DataFrame:
    total = F.sum("duplicated_keys").alias("duplicated_keys")
    return (
        duplicate_summary(_source_tables(spark, sf))
        .agg(total)
        .withColumn("status", F.when(F.col("duplicated_keys") == 0, "OK").otherwise("ERROR"))
    )


@query("event_total_by_day", jobs.EVENT_TOTAL)
def total_by_day(spark: SparkSession, sf: str) -> DataFrame:
    source, silver = jobs.pairs(spark, sf)["booking_events"]
    return event_total(source, silver, b.EVENT_DAY)


# -- windows, sorts, sets ----------------------------------------------------------------------------


@query("latest_per_key", f"SELECT * FROM {b.latest_sql()}")
def latest(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(b.change_log(spark, sf), b.USER_LOG)


@query("latest_per_key_tied", f"SELECT * FROM {b.latest_sql(True)}")
def latest_tied(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(b.change_log(spark, sf, by_day=True), b.USER_LOG)


@query(
    "cluster_for_write",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(date_trunc('month', l_shipdate) AS DATE)
      AS ship_month FROM lineitem""",
)
def clustered(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "clustered")
    lines = b.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.trunc("l_shipdate", "month").alias("ship_month"),
    )
    cluster_for_write(lines, "ship_month").write.partitionBy("ship_month").parquet(path)
    return spark.read.schema(lines.schema).parquet(path)


@query("order_output", f"SELECT * FROM ({jobs.EVENT_DIFF}) ORDER BY event_type")
def order_output(spark: SparkSession, sf: str) -> DataFrame:
    return full_outer_compare(spark, sf).orderBy("event_type")


@query(
    "preview",
    """SELECT l_orderkey, l_linenumber, count(*) AS occurrence FROM lineitem
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
      ORDER BY l_orderkey, l_linenumber LIMIT 5""",
)
def preview(spark: SparkSession, sf: str) -> DataFrame:
    return sample_violations(having_duplicates(spark, sf), "l_orderkey", "l_linenumber")


_TAGGED = [("orders", "o_orderkey"), ("customer", "c_custkey"), ("events", "event_id")]


@query(
    "union_all",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, {k} AS row_key FROM {t}" for t, k in _TAGGED),
)
def tagged_union(spark: SparkSession, sf: str) -> DataFrame:
    return union_all(
        b.table(spark, sf, t).select(F.lit(t).alias("table_name"), F.col(k).alias("row_key"))
        for t, k in _TAGGED
    )


SKETCH_RANGE = ("1994-01-01", "1995-12-31")


@query(
    "distinct_sketches",
    f"""SELECT origin_airport, count(DISTINCT pnr_id) AS exact_count, true AS within_bound FROM {b.SEGMENTS}
      WHERE flight_date BETWEEN DATE '{SKETCH_RANGE[0]}' AND DATE '{SKETCH_RANGE[1]}' GROUP BY origin_airport""",
)
def sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Bookings by origin over two years, from sketches a day that came in two parts, beside the exact count."""
    segments = b.flight_segments(spark, sf).select("flight_date", "origin_airport", "pnr_id", "segment_id")
    by = ("flight_date", "origin_airport")
    early, late = segments.where("segment_id % 3 <> 0"), segments.where("segment_id % 3 = 0")
    stored = merge_sketches(distinct_sketches(early, "pnr_id", *by), distinct_sketches(late, "pnr_id", *by), *by)
    estimated = distinct_in_range(stored, "flight_date", *SKETCH_RANGE, "origin_airport")
    within = segments.where(F.col("flight_date").between(*[F.to_date(F.lit(d)) for d in SKETCH_RANGE]))
    exact = within.groupBy("origin_airport").agg(F.count_distinct("pnr_id").alias("exact_count"))
    off = F.abs(F.col("distinct_estimate") - F.col("exact_count"))
    bound = F.greatest(F.lit(1.0), F.col("exact_count") * relative_error())
    return exact.join(estimated, "origin_airport").select("origin_airport", "exact_count", (off <= bound).alias("within_bound"))
