"""The four jobs end to end, and the reconciliation pair."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.operators.reconcile import count_reconciliation, union_all, verdict
from cdclake.plans.jobs import (
    reconciliation_offenders,
    rejected_table,
    run_bronze,
    run_gold,
    run_reconciliation,
    run_silver,
)
from cdclake.sources.change_files import write_change_files
from cdclake.sources.lake import append_bronze, create_bronze, create_layers, logged_spec, merged_files, read_state, scan_silver
from cdclake.sources.compaction import compact
from cdclake.sources.ledger import log_files, read_files, unmerged
from suite import bindings as b
from suite.lakes import empty_lake, feed_files, fresh_dir, loaded_lake, once, plain, sized_for, state_buckets
from suite.registry import query

# -- marts as SQL over any tables with the right columns ------------------------------------------


def summary_sql(pnr: str) -> str:
    return f"""SELECT CAST(created_at AS DATE) AS booking_date, booking_channel,
      count(*) AS total_bookings FROM {pnr} GROUP BY ALL"""


def cancellation_sql(pnr: str) -> str:
    return f"""SELECT CAST(created_at AS DATE) AS booking_date, count(*) AS total_bookings,
      count(*) FILTER (booking_status = 'CANCELLED') AS cancelled_bookings,
      CAST(count(*) FILTER (booking_status = 'CANCELLED') AS DOUBLE) / count(*) AS cancellation_rate
      FROM {pnr} GROUP BY ALL"""


def payment_sql(payments: str) -> str:
    return f"""SELECT CAST(created_at AS DATE) AS payment_date, payment_method, payment_status,
      count(*) AS payment_count, CAST(sum(amount) AS DECIMAL(16,2)) AS total_amount
      FROM {payments} GROUP BY ALL"""


def revenue_sql(segments: str, payments: str) -> str:
    """Exact in integers: shares are rounded half up at 18 decimals, totals at 2."""
    return f"""WITH seg AS (SELECT * FROM {segments}),
      n AS (SELECT pnr_id, count(*) AS n FROM seg GROUP BY pnr_id),
      t AS (SELECT pnr_id, CAST(sum(amount) * 100 AS HUGEINT) AS c FROM {payments}
        WHERE payment_status = 'SUCCESS' GROUP BY pnr_id),
      a AS (SELECT seg.*, (c * CAST(20000000000000000 AS HUGEINT) + n) // (2 * n) AS share
        FROM seg JOIN n USING (pnr_id) JOIN t USING (pnr_id))
      SELECT flight_date, origin_airport, dest_airport,
        CAST(CAST((sum(share) + CAST(5000000000000000 AS HUGEINT)) // CAST(10000000000000000 AS HUGEINT)
          AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(16,2)) AS total_revenue,
        count(DISTINCT pnr_id) AS total_bookings
      FROM a GROUP BY ALL"""


GOLD = {
    "daily_booking_summary": summary_sql(b.SILVER["pnr_records"]),
    "daily_cancellation_rate": cancellation_sql(b.SILVER["pnr_records"]),
    "revenue_by_route": revenue_sql(b.SILVER["flight_segments"], b.SILVER["payments"]),
    "payment_status_summary": payment_sql(b.SILVER["payments"]),
}

# -- reconciliation: the day-1 source against silver after day 2 -----------------------------------


def pairs(spark: SparkSession, sf: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    lake = loaded_lake(spark, sf)
    return {
        name: (b.SOURCES[name][0](spark, sf), scan_silver(lake, spec))
        for name, spec in b.SPECS.items()
    }


def _sides_sql(columns: str, source: str, silver: str) -> str:
    """Rows of both tables in one, told apart by ``side``."""
    return f"""(SELECT 'source' AS side{columns} FROM {source}
      UNION ALL SELECT 'silver'{columns} FROM {silver})"""


_BOTH_COUNTS = """count(*) FILTER (side = 'source') AS source_count,
      count(*) FILTER (side = 'silver') AS silver_count,
      count(*) FILTER (side = 'silver') - count(*) FILTER (side = 'source') AS difference"""

COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, {_BOTH_COUNTS} FROM {_sides_sql('', source, b.SILVER[name])}"
    for name, (_, source) in b.SOURCES.items()
)


def mismatch_sql(name: str, key: str, status: str) -> str:
    return f"""SELECT s.{key}, s.{status} AS src_status, t.{status} AS target_status,
      count(*) AS pair_count FROM {b.SOURCES[name][1]} s JOIN {b.SILVER[name]} t ON s.{key} = t.{key}
      WHERE s.{status} <> t.{status} GROUP BY ALL"""


def day_sql(table: str) -> str:
    return f"(SELECT * FROM {table} WHERE CAST(created_at AS DATE) = DATE '{b.EVENT_DAY}')"


SOURCE_DAY, SILVER_DAY = day_sql(b.EVENTS), day_sql(b.SILVER["booking_events"])

# The event types of the test tables are never NULL, so grouping both sides together is enough.
EVENT_DIFF = f"""SELECT event_type, {_BOTH_COUNTS}
    FROM {_sides_sql(', event_type', SOURCE_DAY, SILVER_DAY)} GROUP BY event_type"""

EVENT_TOTAL = f"""SELECT source_count, silver_count, abs(difference) AS gap,
    CASE WHEN difference = 0 THEN 'OK' ELSE 'WARNING' END AS status
    FROM (SELECT {_BOTH_COUNTS} FROM {_sides_sql('', SOURCE_DAY, SILVER_DAY)})"""

DUPLICATED = " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, count(*) AS duplicated_keys FROM (SELECT {spec.pk}
      FROM {{{name}}} GROUP BY {spec.pk} HAVING count(*) > 1)"""
    for name, spec in b.SPECS.items()
)


def _status_sql(name: str) -> str:
    spec = b.SPECS[name]
    return f"""SELECT 'state' AS step, '{name}' AS table_name,
      '{spec.status_column}_mismatch' AS check_name, n AS value,
      CASE WHEN n = 0 THEN 'OK' ELSE 'WARNING' END AS status, '' AS detail
      FROM (SELECT CAST(coalesce(sum(pair_count), 0) AS BIGINT) AS n
        FROM ({mismatch_sql(name, spec.pk, spec.status_column)}))"""


RECONCILIATION = f"""
  SELECT 'silver' AS step, table_name, 'row_count_difference' AS check_name, difference AS value,
    CASE WHEN difference = 0 THEN 'OK' ELSE 'WARNING' END AS status,
    'source=' || source_count || ' silver=' || silver_count AS detail FROM ({COUNTS})
  UNION ALL
  SELECT 'silver', table_name, 'duplicated_keys', duplicated_keys,
    CASE WHEN duplicated_keys = 0 THEN 'OK' ELSE 'ERROR' END, ''
    FROM ({DUPLICATED.format(**b.SILVER)})
  UNION ALL {_status_sql('pnr_records')} UNION ALL {_status_sql('payments')}
  UNION ALL
  SELECT 'events_date', 'booking_events', 'event_total_gap', gap, status,
    '{b.EVENT_DAY} source=' || source_count || ' silver=' || silver_count FROM ({EVENT_TOTAL})
  UNION ALL
  SELECT 'events_date', 'booking_events', 'event_type_difference', difference,
    CASE WHEN difference = 0 THEN 'OK' ELSE 'WARNING' END,
    '{b.EVENT_DAY} ' || coalesce(event_type, 'NULL') || ' source=' || source_count ||
    ' silver=' || silver_count FROM ({EVENT_DIFF})"""


@query("run_reconciliation", RECONCILIATION)
def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    return run_reconciliation(pairs(spark, sf), date=b.EVENT_DAY, specs=b.SPECS)


@query(
    "verdict",
    f"""SELECT table_name, difference, CASE WHEN difference = 0 THEN 'OK' ELSE 'WARNING' END AS status
      FROM ({COUNTS})""",
)
def verdicts(spark: SparkSession, sf: str) -> DataFrame:
    return count_reconciliation(pairs(spark, sf)).select(
        "table_name", "difference", verdict(F.col("difference") == 0, "WARNING").alias("status")
    )


@query(
    "run_bronze",
    f"""SELECT event_id, pnr_id, event_type, created_at, 'false' AS __deleted, 'r' AS __op,
      '{b.DAY_1}' AS event_date FROM {b.EVENTS} UNION ALL
      SELECT event_id, pnr_id, event_type, created_at, 'true', 'd', '{b.DAY_2}' FROM {b.EVENTS}
      WHERE event_type = 'error'""",
)
def bronze_job(spark: SparkSession, sf: str) -> DataFrame:
    lake = loaded_lake(spark, sf)
    log = lake.scan(lake.bronze(b.SPECS["booking_events"]))
    return plain(log.drop("__table", "__source_ts_ms"))


@query("run_silver", f"SELECT * FROM {b.SILVER['flight_segments']}")
def silver_job(spark: SparkSession, sf: str) -> DataFrame:
    return plain(scan_silver(loaded_lake(spark, sf), b.SPECS["flight_segments"]))


@query("silver_payments", f"SELECT * FROM {b.SILVER['payments']}")
def silver_payments(spark: SparkSession, sf: str) -> DataFrame:
    return plain(scan_silver(loaded_lake(spark, sf), b.SPECS["payments"]))


@query("silver_passengers", f"SELECT * FROM {b.SILVER['passengers']}")
def silver_passengers(spark: SparkSession, sf: str) -> DataFrame:
    df = scan_silver(loaded_lake(spark, sf), b.SPECS["passengers"])
    return df.drop("created_at", "updated_at")


@query("silver_tickets", f"SELECT * FROM {b.SILVER['tickets']}")
def silver_tickets(spark: SparkSession, sf: str) -> DataFrame:
    df = scan_silver(loaded_lake(spark, sf), b.SPECS["tickets"])
    return df.drop("created_at", "updated_at")


@query("silver_booking_events", f"SELECT * FROM {b.SILVER['booking_events']}")
def silver_events(spark: SparkSession, sf: str) -> DataFrame:
    return plain(scan_silver(loaded_lake(spark, sf), b.SPECS["booking_events"]))


LOG = {"user_events": b.USER_LOG}
LIVE_SQL = f"SELECT user_id, event_id, value FROM {b.latest_sql()} WHERE __op <> 'd'"


@query("run_silver_steps", LIVE_SQL)
def silver_in_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze grows in three steps; each merge finds by itself which days are new or were added to."""
    lake = empty_lake(spark, "steps")
    create_layers(lake, [b.USER_LOG])
    log = b.change_log(spark, sf)
    day = F.col("event_date")
    late = F.col("event_id") % 10 == 0  # arrives last, on days merged before
    for part in ((day < b.CUT) & ~late, (day >= b.CUT) & ~late, late):
        append_bronze(lake, log.where(part), b.USER_LOG)
        run_silver(lake, specs=LOG)
    return scan_silver(lake, b.USER_LOG)


def _flawed(spark: SparkSession, sf: str) -> DataFrame:
    """The change log with keys and codes missing here and there."""
    log = b.change_log(spark, sf)
    key = F.when(F.col("event_id") % 7 != 0, F.col("user_id"))
    code = F.when(F.col("event_id") % 5 != 0, F.col("__op"))
    return log.withColumns({"user_id": key, "__op": code})


@query(
    "run_silver_bad_rows",
    f"""WITH log AS (SELECT * FROM {b.change_log_sql()}), good AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number()
        OVER (PARTITION BY user_id ORDER BY __source_ts_ms DESC, {b.RANK_SQL} DESC, event_id DESC) AS rn
        FROM log WHERE event_id % 7 <> 0 AND event_id % 5 <> 0) WHERE rn = 1 AND __op <> 'd')
      SELECT 'kept' AS what, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(event_id) AS BIGINT) AS ids FROM good
      UNION ALL SELECT 'null_keys', count(*), NULL FROM log WHERE event_id % 7 = 0
      UNION ALL SELECT 'null_ops', count(*), NULL FROM log WHERE event_id % 7 <> 0 AND event_id % 5 = 0""",
)
def silver_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a key or a code are ignored, and the job counts them."""
    lake = empty_lake(spark, "flawed")
    create_layers(lake, [b.USER_LOG])
    append_bronze(lake, _flawed(spark, sf), b.USER_LOG)
    (result,) = run_silver(lake, specs=LOG)
    kept = scan_silver(lake, b.USER_LOG).agg(F.count("*").alias("n_rows"), F.sum("event_id").alias("ids"))
    counted = [(k, result.counts[k], None) for k in ("null_keys", "null_ops")]
    return kept.select(F.lit("kept").alias("what"), "n_rows", "ids").unionByName(
        spark.createDataFrame(counted, "what string, n_rows bigint, ids bigint")
    )


@query(
    "quarantine",
    f"""SELECT 'loaded' AS what, CAST(count(*) AS BIGINT) AS n_rows FROM {b.PAYMENTS} WHERE amount < 150000
      UNION ALL SELECT 'rejected', count(*) FROM {b.PAYMENTS} WHERE amount >= 150000
      UNION ALL SELECT 'counted', count(*) FROM {b.PAYMENTS} WHERE amount >= 150000""",
)
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts too large for their type are set aside; the rest of the day is loaded."""
    spec = b.SPECS["payments"]
    root, lake = fresh_dir(spark, "overflow"), empty_lake(spark, "overflow")
    day = b.feed(spark, sf, "payments").where(F.col("event_date") == b.DAY_1)
    amount = F.col("amount").cast("double")
    write_change_files(day.withColumn("amount", F.when(amount >= 150000, amount * 1e9).otherwise(amount)), root, spec)
    create_bronze(lake, [spec])
    (result,) = run_bronze(lake, root, b.DAY_1, specs={"payments": spec}, quarantine=True)
    loaded = lake.scan(lake.bronze(spec)).agg(F.count("*").alias("n_rows"))
    rejected = lake.scan(rejected_table(lake, spec)).agg(F.count("*").alias("n_rows"))
    return union_all(
        [
            loaded.select(F.lit("loaded").alias("what"), "n_rows"),
            rejected.select(F.lit("rejected").alias("what"), "n_rows"),
            spark.createDataFrame([("counted", result.counts["rejected"])], "what string, n_rows bigint"),
        ]
    )


@query(
    "run_bronze_reload",
    f"""SELECT payment_id, payment_status, '{b.DAY_1}' AS event_date, 'log' AS kept_in FROM {b.PAYMENTS}
      UNION ALL SELECT CAST(o_orderkey AS VARCHAR), {b.recode_sql("implied", b.PAYMENT)}, '{b.DAY_2}', 'rejected'
      FROM {b.IMPLIED} WHERE implied IS NOT NULL""",
)
def bronze_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Day 2 is loaded, then loaded again from files in which no row fits: it ends empty, day 1 stays."""
    spec = b.SPECS["payments"]
    root, bad = fresh_dir(spark, "reload"), fresh_dir(spark, "reload")
    lake = empty_lake(spark, "reload")
    create_bronze(lake, [spec])
    feed = b.feed(spark, sf, "payments")
    write_change_files(feed, root, spec)
    day_2 = feed.where(F.col("event_date") == b.DAY_2)
    write_change_files(day_2.withColumn("amount", F.col("amount").cast("double") + 1e12), bad, spec)
    for where, day in ((root, b.DAY_1), (root, b.DAY_2), (bad, b.DAY_2)):
        run_bronze(lake, where, day, specs={spec.name: spec}, quarantine=True)
    field = lambda name: F.get_json_object("row", f"$.{name}").alias(name)
    log = lake.scan(lake.bronze(spec)).select("payment_id", "payment_status", "event_date")
    aside = lake.scan(rejected_table(lake, spec)).select(field("payment_id"), field("payment_status"), "event_date")
    return log.withColumn("kept_in", F.lit("log")).unionByName(aside.withColumn("kept_in", F.lit("rejected")))


WIDE_SQL = "CASE WHEN event_type = 'signup' THEN concat_ws('-', event_type, event_id) END"


def widened_lake(spark: SparkSession, sf: str):
    """Day 1 without the column `channel`, day 2 with it, each through bronze and silver."""

    def build():
        spec = b.SPECS["booking_events"]
        root, lake = fresh_dir(spark, "widened"), empty_lake(spark, "widened")
        create_layers(lake, [spec])
        feed = b.feed(spark, sf, "booking_events").where(F.col("event_date") == b.DAY_1)
        write_change_files(feed, root, spec)
        later = feed.where("event_type = 'signup'").withColumns(
            {"channel": F.concat_ws("-", "event_type", "event_id"), "event_date": F.lit(b.DAY_2), "__op": F.lit("u"), "__source_ts_ms": F.lit(b.MS_2).cast("long")}
        )
        write_change_files(later, root, spec)
        for day in (b.DAY_1, b.DAY_2):
            run_bronze(lake, root, day, specs={spec.name: spec}, new_columns="widen")
            run_silver(lake, specs={spec.name: spec})
        return lake, logged_spec(lake, spec)

    return once(spark, sf, "widened", build)


@query("schema_widening", f"SELECT *, {WIDE_SQL} AS channel FROM {b.EVENTS}")
def schema_widening(spark: SparkSession, sf: str) -> DataFrame:
    """Silver after a column came with day 2."""
    return plain(scan_silver(*widened_lake(spark, sf)))


@query(
    "schema_widening_log",
    f"""SELECT event_id, 'r' AS __op, '{b.DAY_1}' AS event_date, NULL AS channel FROM {b.EVENTS}
      UNION ALL SELECT event_id, 'u', '{b.DAY_2}', {WIDE_SQL} FROM {b.EVENTS} WHERE event_type = 'signup'""",
)
def schema_widening_log(spark: SparkSession, sf: str) -> DataFrame:
    """Both days of the log read back under the wider schema."""
    lake, spec = widened_lake(spark, sf)
    return lake.scan(lake.bronze(spec)).select("event_id", "__op", "event_date", "channel")


@query(
    "run_silver_files",
    f"""SELECT event_date, count(*) AS n_rows, CAST(count(*) FILTER (event_id % 10 = 0) AS BIGINT) AS n_fresh
      FROM {b.change_log_sql()} GROUP BY event_date""",
)
def silver_files(spark: SparkSession, sf: str) -> DataFrame:
    """What the next merge would read after rows were added to days merged before: the new files' rows alone."""
    lake = empty_lake(spark, "files")
    create_layers(lake, [b.USER_LOG])
    log, late = b.change_log(spark, sf), F.col("event_id") % 10 == 0
    append_bronze(lake, log.where(~late), b.USER_LOG)
    run_silver(lake, specs=LOG)
    append_bronze(lake, log.where(late), b.USER_LOG)
    name = lake.bronze(b.USER_LOG)
    fresh, _ = read_files(spark, name, unmerged(log_files(spark, name), merged_files(lake, b.USER_LOG)))
    whole = lake.scan(name).groupBy("event_date").agg(F.count("*").alias("n_rows"))
    new = fresh.groupBy("event_date").agg(F.count("*").alias("n_fresh"))
    return whole.join(new, "event_date", "left").fillna(0, ["n_fresh"])


@query(
    "compact_days",
    f"""SELECT event_date, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS ids, true AS few_files,
      CAST(0 AS BIGINT) AS days_to_merge FROM {b.change_log_sql()} GROUP BY event_date""",
)
def compact_days(spark: SparkSession, sf: str) -> DataFrame:
    """Many small files a day become one; rows stay, and silver has nothing to merge again."""
    lake = empty_lake(spark, "compact")
    create_layers(lake, [b.USER_LOG])
    append_bronze(lake, b.change_log(spark, sf).repartition(12, "event_id"), b.USER_LOG)
    run_silver(lake, specs=LOG)
    compact(lake, b.USER_LOG, before="9999-12-31")
    (result,) = run_silver(lake, specs=LOG)
    name = lake.bronze(b.USER_LOG)
    files = log_files(spark, name).groupBy("event_date").agg((F.count("*") <= 4).alias("few_files"))
    rows = lake.scan(name).groupBy("event_date").agg(F.count("*").alias("n_rows"), F.sum("event_id").alias("ids"))
    return rows.join(files, "event_date").withColumn("days_to_merge", F.lit(result.counts["days"]).cast("long"))


MARK_SQL = f"epoch_us(TIMESTAMP '{b.CUT}') // 1000"


@query(
    "tombstone_expiry",
    f"""WITH log AS (SELECT *, __source_ts_ms < {MARK_SQL} AS old FROM {b.change_log_sql()}),
        taken AS (SELECT * FROM log WHERE NOT old OR event_id % 10 <> 0),
        latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id
          ORDER BY __source_ts_ms DESC, {b.RANK_SQL} DESC, event_id DESC) AS rn FROM taken) WHERE rn = 1)
      SELECT 'live' AS what, user_id, event_id, value FROM latest WHERE __op <> 'd'
      UNION ALL SELECT 'deleted', user_id, event_id, value FROM latest WHERE __op = 'd' AND NOT old
      UNION ALL SELECT 'too_old', NULL, count(*), NULL FROM log WHERE old AND event_id % 10 = 0""",
)
def tombstone_expiry(spark: SparkSession, sf: str) -> DataFrame:
    """Changes up to a day, then the rest with that day as the oldest accepted: older ones are refused and counted,
    older deletes are gone from the state, and every row that readers see is as if nothing had been forgotten."""
    lake = empty_lake(spark, "expiry")
    create_layers(lake, [b.USER_LOG])
    log = b.change_log(spark, sf)
    old, late = F.col("event_date") < b.CUT, F.col("event_id") % 10 == 0
    append_bronze(lake, log.where(old & ~late), b.USER_LOG)
    run_silver(lake, specs=LOG)
    append_bronze(lake, log.where(~old | late), b.USER_LOG)
    (result,) = run_silver(lake, specs=LOG, oldest=b.CUT)
    state = read_state(lake, b.USER_LOG)
    what = F.when(F.col("__op") == "d", "deleted").otherwise("live").alias("what")
    refused = spark.createDataFrame([("too_old", None, result.counts["too_old"], None)], "what string, user_id bigint, event_id bigint, value double")
    return state.select(what, *[F.col(c).cast(t).alias(c) for c, t in refused.dtypes[1:]]).unionByName(refused)


@query("topic_directories", f"SELECT * FROM {b.change_log_sql()} WHERE event_date = '{b.EVENT_DAY}'")
def topic_directories(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a sink that names directories by topic."""
    root, lake, layout = fresh_dir(spark, "topics"), empty_lake(spark, "topics"), "booking.public.{table}"
    write_change_files(b.change_log(spark, sf), root, b.USER_LOG, layout=layout)
    create_bronze(lake, [b.USER_LOG])
    run_bronze(lake, root, b.EVENT_DAY, specs=LOG, layout=layout)
    return lake.scan(lake.bronze(b.USER_LOG))


@query(
    "sequence_order",
    f"""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY epoch_us(CAST(CAST(strptime(event_date, '%Y-%m-%d') AS DATE) AS TIMESTAMP)) DESC, event_id DESC) AS rn
      FROM {b.change_log_sql()}) WHERE rn = 1 AND __op <> 'd'""",
)
def sequence_order(spark: SparkSession, sf: str) -> DataFrame:
    """Source times that are equal for a whole day: the log sequence decides, through bronze and silver."""
    spec = replace(b.USER_LOG, seq_column="lsn")
    lake = empty_lake(spark, "sequence")
    create_layers(lake, [spec])
    log = b.change_log(spark, sf, by_day=True).withColumn("lsn", F.col("event_id").cast("long"))
    for rest in (1, 0):
        append_bronze(lake, log.where(F.col("event_id") % 2 == rest), spec)
        run_silver(lake, specs={"user_events": spec})
    return scan_silver(lake, spec)


@query(
    "reconciliation_offenders",
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{name}' AS table_name, '{b.SPECS[name].status_column}_mismatch' AS check_name,
          CAST({b.SPECS[name].pk} AS VARCHAR) AS key, 'source=' || src_status || ' silver=' || target_status AS detail
          FROM ({mismatch_sql(name, b.SPECS[name].pk, b.SPECS[name].status_column)}) ORDER BY {b.SPECS[name].pk} LIMIT 5)"""
        for name in ("pnr_records", "payments")
    ),
)
def offenders(spark: SparkSession, sf: str) -> DataFrame:
    return reconciliation_offenders(pairs(spark, sf), b.SPECS)


@query("run_gold", GOLD["revenue_by_route"])
def gold_job(spark: SparkSession, sf: str) -> DataFrame:
    lake = loaded_lake(spark, sf)
    return lake.scan(lake.gold("revenue_by_route"))


def _gold(mart: str):
    @query(f"gold_{mart}", GOLD[mart])
    def read(spark: SparkSession, sf: str) -> DataFrame:
        lake = loaded_lake(spark, sf)
        return lake.scan(lake.gold(mart))


for _mart in ("daily_booking_summary", "daily_cancellation_rate", "payment_status_summary"):
    _gold(_mart)


# -- marts brought up to date from the rows of silver that differ ----------------------------------


def changed_lake(spark: SparkSession, sf: str):
    """Gold made after day 1, then brought up to date after day 2, and how many days that wrote."""

    def build():
        specs = {n: b.SPECS[n] for n in ("pnr_records", "payments", "flight_segments")}
        root, lake = feed_files(spark, sf), empty_lake(spark, "changed", state_buckets(spark, sf))
        create_layers(lake, specs.values())
        for day in (b.DAY_1, b.DAY_2):
            with sized_for(spark, lake.state_buckets):
                run_bronze(lake, root, day, specs=specs)
                run_silver(lake, specs=specs)
                results = run_gold(lake, specs=specs, changed_only=True)
        return lake, {r.item: r.counts for r in results}

    return once(spark, sf, "changed", build)


def _gold_changed(mart: str):
    @query(f"gold_changed_{mart}", GOLD[mart])
    def read(spark: SparkSession, sf: str) -> DataFrame:
        lake, _ = changed_lake(spark, sf)
        return lake.scan(lake.gold(mart))


for _mart in GOLD:
    _gold_changed(_mart)


def _days_sql(mart: str, day: str, before: str, after: str) -> str:
    return f"""SELECT '{mart}' AS mart, count(DISTINCT coalesce({day}, DATE '0001-01-01')) AS days,
      CAST(0 AS BIGINT) AS whole FROM
      ((({before}) EXCEPT ({after})) UNION ALL (({after}) EXCEPT ({before})))"""


@query(
    "gold_changed_days",
    " UNION ALL ".join(
        _days_sql(mart, day, sql(b.SOURCES[name][1]), sql(b.SILVER[name]))
        for mart, day, sql, name in (
            ("daily_booking_summary", "booking_date", summary_sql, "pnr_records"),
            ("daily_cancellation_rate", "booking_date", cancellation_sql, "pnr_records"),
            ("payment_status_summary", "payment_date", payment_sql, "payments"),
        )
    ),
)
def gold_changed_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days that the second run wrote: those in which a mart differs, no others."""
    _, counts = changed_lake(spark, sf)
    done = [(m, c["days"], c["whole"]) for m, c in sorted(counts.items()) if m != "revenue_by_route"]
    return spark.createDataFrame(done, "mart string, days bigint, whole bigint")
