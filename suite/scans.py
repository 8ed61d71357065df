"""Sources, sinks and the catalog."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.operators import marts
from cdclake.operators.reconcile import union_all
from cdclake.plans.jobs import run_reconciliation, write_report
from cdclake.sources.change_files import read_changes, table_path
from cdclake.sources.lake import (
    append_bronze,
    apply_changes,
    create_bronze,
    create_layers,
    create_silver,
    list_namespaces,
    list_tables,
    refresh,
    register_pair,
    reset,
    scan_silver,
)
from cdclake.specs import MARTS
from suite import bindings as b
from suite import jobs
from suite.lakes import empty_lake, fresh_dir, loaded_lake, plain, user_files
from suite.registry import query


@query(
    "scan_change_partition",
    f"SELECT * FROM {b.change_log_sql()} WHERE event_date = '{b.EVENT_DAY}'",
)
def scan_change_partition(spark: SparkSession, sf: str) -> DataFrame:
    return read_changes(spark, user_files(spark, sf), b.USER_LOG, b.EVENT_DAY)


def _bronze_counts(lake, specs=b.SPECS) -> DataFrame:
    return union_all(
        lake.scan(lake.bronze(spec))
        .groupBy(F.lit(name).alias("table_name"), "event_date")
        .agg(F.count("*").alias("n_rows"))
        for name, spec in specs.items()
    )


_INGESTED = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{day}' AS event_date, count(*) AS n_rows FROM {src}"
    for name, both in b.FEED_COUNTS.items()
    for day, src in zip((b.DAY_1, b.DAY_2), both)
)


@query("ingest_all_tables", _INGESTED)
def ingest_all_tables(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze_counts(loaded_lake(spark, sf))


def _loaded_twice(spark: SparkSession, sf: str, label: str, idempotent: bool) -> DataFrame:
    lake = empty_lake(spark, label)
    create_bronze(lake, [b.USER_LOG])
    changes = read_changes(spark, user_files(spark, sf), b.USER_LOG)
    for _ in range(2):
        append_bronze(lake, changes, b.USER_LOG, idempotent)
    return lake.scan(lake.bronze(b.USER_LOG))


@query("append_bronze", f"SELECT * FROM {b.change_log_sql()}")
def append_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches share every arrival day; both stay."""
    lake = empty_lake(spark, "append")
    create_bronze(lake, [b.USER_LOG])
    changes = read_changes(spark, user_files(spark, sf), b.USER_LOG)
    for rest in (0, 1):
        append_bronze(lake, changes.where(F.col("event_id") % 2 == rest), b.USER_LOG)
    return lake.scan(lake.bronze(b.USER_LOG))


@query("append_twice", f"SELECT * FROM {b.change_log_sql()} UNION ALL SELECT * FROM {b.change_log_sql()}")
def append_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Plain append doubles a day that is loaded again."""
    return _loaded_twice(spark, sf, "twice", idempotent=False)


@query("late_and_replayed", f"SELECT * FROM {b.change_log_sql()}")
def replace_day(spark: SparkSession, sf: str) -> DataFrame:
    """Loading a day again replaces it."""
    return _loaded_twice(spark, sf, "replay", idempotent=True)


@query("scan_table", f"SELECT * FROM {b.SILVER['pnr_records']}")
def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    lake = loaded_lake(spark, sf)
    return plain(lake.scan(lake.silver(b.SPECS["pnr_records"])))


@query(
    "register_views",
    f"""SELECT s.booking_status AS source_status, t.booking_status AS silver_status,
      count(*) AS n_rows FROM {b.PNR} s JOIN {b.SILVER['pnr_records']} t ON s.pnr_id = t.pnr_id
      GROUP BY ALL""",
)
def register_views(spark: SparkSession, sf: str) -> DataFrame:
    spec = b.SPECS["pnr_records"]
    silver = scan_silver(loaded_lake(spark, sf), spec)
    source_view, silver_view = register_pair(spec, b.pnr_records(spark, sf), silver)
    return spark.sql(
        f"""SELECT s.booking_status AS source_status, t.booking_status AS silver_status,
        count(*) AS n_rows FROM {source_view} s JOIN {silver_view} t USING (pnr_id)
        GROUP BY s.booking_status, t.booking_status"""
    )


@query(
    "merge_sink",
    f"SELECT user_id, event_id, value FROM {b.latest_sql()} WHERE __op <> 'd'",
)
def merge_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The later half of the log is applied first; the table ends the same."""
    lake = empty_lake(spark, "merge")
    create_silver(lake, [b.USER_LOG])
    log = b.change_log(spark, sf)
    apply_changes(lake, log.where(F.col("event_date") >= b.CUT), b.USER_LOG)
    apply_changes(lake, log.where(F.col("event_date") < b.CUT), b.USER_LOG)
    return scan_silver(lake, b.USER_LOG)


@query(
    "overwrite_sink",
    f"""SELECT CAST(created_at AS DATE) AS booking_date, booking_channel,
      count(*) AS total_bookings FROM {b.SILVER['pnr_records']} GROUP BY ALL""",
)
def overwrite_sink(spark: SparkSession, sf: str) -> DataFrame:
    """A mart of all orders is replaced by that of silver; days only the first had are gone."""
    lake = empty_lake(spark, "overwrite")
    create_layers(lake, [])
    refresh(lake, marts.daily_booking_summary(b.pnr_records(spark, sf)), "daily_booking_summary")
    silver = scan_silver(loaded_lake(spark, sf), b.SPECS["pnr_records"])
    refresh(lake, marts.daily_booking_summary(silver), "daily_booking_summary")
    return lake.scan(lake.gold("daily_booking_summary"))


def _census(lake, layer: str, tables: dict[str, str]) -> DataFrame:
    """(layer, table_name, n_columns, n_rows) of catalog tables."""
    return union_all(
        lake.scan(full)
        .agg(F.count("*").alias("n_rows"))
        .select(
            F.lit(layer).alias("layer"),
            F.lit(name).alias("table_name"),
            F.lit(len(lake.scan(full).columns)).alias("n_columns"),
            "n_rows",
        )
        for name, full in tables.items()
    )


def _census_sql(layer: str, tables: dict[str, tuple[int, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, {n} AS n_columns, count(*) AS n_rows FROM {src}"
        for name, (n, src) in tables.items()
    )


_BRONZE_SQL = _census_sql(
    "bronze",
    {
        name: (
            len(b.SPECS[name].columns) + 5,
            f"(SELECT 1 AS x FROM {one} UNION ALL SELECT 1 FROM {two})",
        )
        for name, (one, two) in b.FEED_COUNTS.items()
    },
)
_SILVER_SQL = _census_sql(
    "silver",
    {
        spec.silver_name: (len(spec.columns) + bool(spec.month_of), b.SILVER[name])
        for name, spec in b.SPECS.items()
    },
)
_GOLD_SQL = _census_sql(
    "gold", {mart: (len(MARTS[mart][0]), f"({jobs.GOLD[mart]})") for mart in MARTS}
)


@query("create_bronze_tables", _BRONZE_SQL)
def bronze_tables(spark: SparkSession, sf: str) -> DataFrame:
    lake = loaded_lake(spark, sf)
    return _census(lake, "bronze", {n: lake.bronze(s) for n, s in b.SPECS.items()})


@query("create_silver_tables", _SILVER_SQL)
def silver_tables(spark: SparkSession, sf: str) -> DataFrame:
    lake = loaded_lake(spark, sf)
    return _census(lake, "silver", {s.silver_name: lake.silver(s) for s in b.SPECS.values()})


@query("create_gold_tables", _GOLD_SQL)
def gold_tables(spark: SparkSession, sf: str) -> DataFrame:
    lake = loaded_lake(spark, sf)
    return _census(lake, "gold", {m: lake.gold(m) for m in MARTS})


@query(
    "list_catalog",
    f"SELECT layer, table_name, n_rows FROM ({_BRONZE_SQL} UNION ALL {_SILVER_SQL} UNION ALL {_GOLD_SQL})",
)
def list_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Every table the catalog lists for readers, with its row count."""
    lake = loaded_lake(spark, sf)
    listed = list_tables(lake).collect()
    return union_all(
        _census(lake, r.layer, {r.table_name: lake.table(r.layer, r.table_name)}) for r in listed
    ).drop("n_columns")


@query(
    "create_namespaces",
    f"""SELECT layer, count(*) AS n_tables, CAST(sum(n_rows) AS BIGINT) AS n_rows
      FROM ({_BRONZE_SQL} UNION ALL {_SILVER_SQL} UNION ALL {_GOLD_SQL}) GROUP BY layer""",
)
def namespaces(spark: SparkSession, sf: str) -> DataFrame:
    """The lake's namespaces that the catalog has, with what is in them."""
    lake = loaded_lake(spark, sf)
    own = list_namespaces(lake).where(F.col("namespace").startswith(lake.prefix))
    layers = own.select(F.substring_index("namespace", "_", -1).alias("layer"))
    return (
        list_catalog(spark, sf)
        .join(layers, "layer")
        .groupBy("layer")
        .agg(F.count("*").alias("n_tables"), F.sum("n_rows").alias("n_rows"))
    )


@query(
    "drop_layers",
    _census_sql("silver", {"user_events_clean": (3, f"(SELECT 1 FROM {b.latest_sql()} WHERE __op <> 'd')")}),
)
def drop_layers(spark: SparkSession, sf: str) -> DataFrame:
    """After dropping bronze, what is left is silver."""
    lake = empty_lake(spark, "drop")
    create_bronze(lake, [b.USER_LOG])
    create_silver(lake, [b.USER_LOG])
    append_bronze(lake, b.change_log(spark, sf), b.USER_LOG)
    apply_changes(lake, lake.scan(lake.bronze(b.USER_LOG)), b.USER_LOG)
    reset(lake, ["bronze"])
    left = list_tables(lake).collect()
    return union_all(
        _census(lake, r.layer, {r.table_name: lake.table(r.layer, r.table_name)}) for r in left
    )


@query("report_sink", jobs.RECONCILIATION)
def report_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "reports")
    checks = run_reconciliation(
        jobs.pairs(spark, sf), date=b.EVENT_DAY, specs=b.SPECS
    )
    write_report(checks, path, dt.datetime(2024, 1, 31))
    return spark.read.parquet(path).drop("run_ts")


@query(
    "evolving_scan",
    f"""SELECT user_id, event_id, value, CASE WHEN event_date >= '{b.CUT}' THEN props END AS props,
      __op, event_date FROM (SELECT {b.OP_SQL} AS __op, strftime(ts, '%Y-%m-%d') AS event_date, *
      FROM events)""",
)
def evolving_scan(spark: SparkSession, sf: str) -> DataFrame:
    """From the cut on, files carry a column that older ones lack."""
    root = fresh_dir(spark, "evolving")
    log = b.change_log(spark, sf)
    newer = log.join(b.table(spark, sf, "events").select("event_id", "props"), "event_id")
    for part in (
        log.where(F.col("event_date") < b.CUT),
        newer.where(F.col("event_date") >= b.CUT),
    ):
        part.write.mode("append").partitionBy("event_date", "__op").parquet(
            table_path(root, b.USER_LOG)
        )
    return read_changes(spark, root, b.USER_LOG, merge_schema=True).select(
        "user_id", "event_id", "value", "props", "__op", "event_date"
    )


@query(
    "sql_surface",
    f"""SELECT booking_channel, CAST(sum(total_bookings) AS BIGINT) AS bookings,
      count(DISTINCT booking_date) AS active_days FROM ({jobs.GOLD['daily_booking_summary']})
      GROUP BY booking_channel""",
)
def sql_surface(spark: SparkSession, sf: str) -> DataFrame:
    lake = loaded_lake(spark, sf)
    return spark.sql(
        f"""SELECT booking_channel, sum(total_bookings) AS bookings,
        count(DISTINCT booking_date) AS active_days
        FROM {lake.gold('daily_booking_summary')} GROUP BY booking_channel"""
    )
