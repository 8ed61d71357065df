"""Streaming queries, each run until its input is used up and read back."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.operators.changes import latest_per_key
from cdclake.operators.merge import current_rows
from cdclake.sources.change_files import read_changes, table_path, write_change_files
from cdclake.operators.handover import Mark, snapshot_changes, tail
from cdclake.sources.lake import apply_changes, begin_hand_over, create_layers, create_silver, hand_over_mark, merged_batch, read_state, scan_silver
from cdclake.streaming.capture import stream_bronze, stream_changes, write_changes
from cdclake.streaming.messages import capture_all, captured_changes, dead_letters, stream_messages
from cdclake.streaming.upsert import query_id, stream_change_files, stream_silver
from cdclake.operators.reconcile import union_all
from suite import bindings as b
from suite.lakes import empty_lake, envelope_files, fresh_dir, once, plain, small_tasks, user_files
from suite.registry import query

ONCE = {"availableNow": True}


def captured(spark: SparkSession, sf: str) -> str:
    """Root of the change files that the capture stream wrote from the envelope files."""

    def build() -> str:
        root, checkpoint = fresh_dir(spark, "captured"), fresh_dir(spark, "ckpt")
        options = {"path": envelope_files(spark, sf)}
        stream_bronze(spark, "json", options, b.EVENT_SPEC, root, checkpoint, ONCE).awaitTermination()
        return root

    return once(spark, sf, "captured", build)


@query("stream_bronze", f"SELECT * FROM {b.FLAT_SQL}")
def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return b.flat_view(read_changes(spark, captured(spark, sf), b.EVENT_SPEC))


@query(
    "scan_kafka_changes",
    """SELECT 'cdc.shop.dbo.booking_events' AS topic, event_id AS row_key, epoch_us(ts) // 1000 AS ts_ms,
      CASE WHEN event_type = 'error' THEN 'd' WHEN event_type = 'signup' THEN 'c'
        WHEN event_type = 'view' THEN 'r' ELSE 'u' END AS op FROM events""",
)
def envelope_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The feed as it is read, over the file form of the source."""
    feed = stream_changes(spark, "json", {"path": envelope_files(spark, sf)}, b.EVENT_SPEC)
    path, checkpoint = fresh_dir(spark, "feed-copy"), fresh_dir(spark, "ckpt")
    (
        feed.select("topic", F.coalesce("after.event_id", "before.event_id").alias("row_key"), "ts_ms", "op")
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**ONCE)
        .start(path)
        .awaitTermination()
    )
    return spark.read.parquet(path)


@query(
    "sink_change_files",
    f"SELECT event_date, __op, count(*) AS n_rows FROM {b.change_log_sql()} GROUP BY ALL",
)
def file_sink(spark: SparkSession, sf: str) -> DataFrame:
    root, checkpoint = fresh_dir(spark, "sink"), fresh_dir(spark, "ckpt")
    log = stream_change_files(spark, user_files(spark, sf), b.USER_LOG)
    write_changes(log, root, b.USER_LOG, checkpoint, ONCE).awaitTermination()
    written = spark.read.parquet(table_path(root, b.USER_LOG))
    return written.groupBy(F.col("event_date").cast("string").alias("event_date"), "__op").agg(
        F.count("*").alias("n_rows")
    )


@query(
    "stream_silver",
    f"SELECT user_id, event_id, value FROM {b.latest_sql()} WHERE __op <> 'd'",
)
def silver(spark: SparkSession, sf: str) -> DataFrame:
    """The change files in several micro-batches, merged one after the other."""
    lake = empty_lake(spark, "stream")
    create_silver(lake, [b.USER_LOG])
    log = stream_change_files(spark, user_files(spark, sf), b.USER_LOG, maxFilesPerTrigger="40")
    stream_silver(log, b.USER_LOG, lake, fresh_dir(spark, "ckpt"), ONCE).awaitTermination()
    return plain(scan_silver(lake, b.USER_LOG))


@query(
    "stream_replay",
    f"""SELECT user_id, event_id, value, false AS applied, false AS files_changed FROM {b.latest_sql()}
      WHERE __op <> 'd'""",
)
def replay(spark: SparkSession, sf: str) -> DataFrame:
    """The last batch handed in again under its id, with every value changed: known, so nothing is merged or written."""
    lake, checkpoint = empty_lake(spark, "replay"), fresh_dir(spark, "ckpt")
    create_silver(lake, [b.USER_LOG])
    root = user_files(spark, sf)
    log = stream_change_files(spark, root, b.USER_LOG, maxFilesPerTrigger="60")
    stream_silver(log, b.USER_LOG, lake, checkpoint, ONCE).awaitTermination()
    query = query_id(spark, checkpoint)
    files = read_state(lake, b.USER_LOG).inputFiles()
    again = read_changes(spark, root, b.USER_LOG).withColumns(
        {"value": F.lit(-1.0), "__source_ts_ms": F.col("__source_ts_ms") + 1}
    )
    applied = apply_changes(lake, again, b.USER_LOG, batch=(query, merged_batch(lake, b.USER_LOG, query)))
    changed = files != read_state(lake, b.USER_LOG).inputFiles()
    return scan_silver(lake, b.USER_LOG).withColumns(
        {"applied": F.lit(applied), "files_changed": F.lit(changed)}
    )


@query(
    "stream_dead_letters",
    f"""SELECT event_id, CASE event_id % 50 WHEN 7 THEN 'json' WHEN 8 THEN 'type' WHEN 9 THEN 'code' WHEN 10 THEN 'image' END
        AS reason, CASE WHEN event_id % 50 NOT IN (7, 8, 9, 10) THEN {b.OP_SQL} END AS __op,
        CASE event_id % 50 WHEN 7 THEN '{{"after": {{"event_id": ' || event_id WHEN 10 THEN '{{"op":"u","event_id":' || event_id || '}}' END AS raw,
        strftime(ts, '%Y-%m-%d') AS event_date FROM events""",
)
def malformed(spark: SparkSession, sf: str) -> DataFrame:
    """Some messages are cut off, hold a word for a number, lack their code or their row; the stream goes on."""
    rest = F.col("event_id") % 50
    feed = b.change_events(spark, sf)
    cut = F.format_string('{"after": {"event_id": %d', "event_id")
    bare = F.format_string('{"op":"u","event_id":%d}', "event_id")
    word = F.regexp_replace("value", '"event_id":([0-9]+)', '"event_id":"no $1"')
    no_code = F.regexp_replace("value", '"op":"."', '"code":"x"')
    sent = b.as_messages(feed, b.EVENT_SPEC, "event_id")
    value = F.when(rest == 7, cut).when(rest == 8, word).when(rest == 9, no_code).when(rest == 10, bare).otherwise(F.col("value"))
    path, root = fresh_dir(spark, "messages"), fresh_dir(spark, "captured-all")
    sent.withColumn("value", value).withColumn("offset", F.col("event_id").cast("long")).drop("event_id").write.parquet(path)
    messages = stream_messages(spark, "parquet", {"path": path, "maxFilesPerTrigger": "2"})
    capture_all(messages, [b.EVENT_SPEC], root, fresh_dir(spark, "ckpt"), ONCE).awaitTermination()
    kept = captured_changes(spark, root, b.EVENT_SPEC)
    none = F.lit(None).cast("string")
    aside = dead_letters(spark, root).select(
        F.col("offset").cast("int").alias("event_id"),
        "reason",
        none.alias("__op"),
        F.when(F.col("reason").isin("json", "image"), F.col("raw")).alias("raw"),
        "event_date",
    )
    return kept.select("event_id", none.alias("reason"), "__op", none.alias("raw"), "event_date").unionByName(aside)


@query(
    "stream_all_tables",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, 'r' AS __op, '{b.DAY_1}' AS event_date, {b.row_text(b.SPECS[name])} AS row
          FROM {source}"""
        for name, (_, source) in b.SOURCES.items()
    ),
)
def all_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Six topics, one query, one checkpoint; every table read back with its types."""
    path, root = fresh_dir(spark, "messages"), fresh_dir(spark, "captured-all")
    for name, spec in b.SPECS.items():
        day = b.feed(spark, sf, name).where(F.col("event_date") == b.DAY_1)
        b.as_messages(day, spec).write.mode("append").parquet(path)
    with small_tasks(spark):  # a task sorts parsed messages, many times their size in the files
        messages = stream_messages(spark, "parquet", {"path": path})
        capture_all(messages, b.SPECS.values(), root, fresh_dir(spark, "ckpt"), ONCE).awaitTermination()
    return union_all(
        [
            captured_changes(spark, root, spec).select(
                F.col("__table").alias("table_name"),
                "__op",
                "event_date",
                F.expr(b.row_text(spec, "unix_millis({})")).alias("row"),
            )
            for spec in b.SPECS.values()
        ]
    )


POSITIONED = replace(b.USER_LOG, seq_column="lsn")


def _positioned(spark: SparkSession, sf: str) -> DataFrame:
    """The user change log by position; the source time moves every hundred positions."""
    position = F.col("event_id").cast("long")
    stamped = b.change_log(spark, sf).withColumns({"lsn": position, "__source_ts_ms": F.floor(position / 100)})
    return stamped.select(*POSITIONED.change_schema.fieldNames())


@query(
    "snapshot_hand_over",
    f"""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
      FROM {b.change_log_sql()}) WHERE rn = 1 AND __op <> 'd'""",
)
def hand_over(spark: SparkSession, sf: str) -> DataFrame:
    """A table is read while its log goes on. The stream starts before the mark and is merged before the
    snapshot; half of the snapshot's rows were read at the mark, half much later. Result: one fold of the log."""
    lake, root = empty_lake(spark, "handover"), fresh_dir(spark, "positions")
    create_layers(lake, [POSITIONED])
    log = _positioned(spark, sf)
    last = log.agg(F.max("lsn").alias("n")).first().n
    mark = Mark(position=last // 2, ts_ms=last // 2 // 100)
    begin_hand_over(lake, POSITIONED, mark)
    write_change_files(log.where(F.col("lsn") > last // 4), root, POSITIONED)

    def table_at(position: int) -> DataFrame:
        return current_rows(latest_per_key(log.where(F.col("lsn") <= position), POSITIONED), POSITIONED)

    read_early, read_late = table_at(mark.position).where("user_id % 2 = 0"), table_at(last * 3 // 4).where("user_id % 2 = 1")
    snapshot = snapshot_changes(read_early.unionByName(read_late), POSITIONED, mark, b.DAY_1)
    changes = tail(stream_change_files(spark, root, POSITIONED), POSITIONED, hand_over_mark(lake, POSITIONED))
    stream_silver(changes, POSITIONED, lake, fresh_dir(spark, "ckpt"), ONCE).awaitTermination()
    apply_changes(lake, snapshot, POSITIONED)
    return scan_silver(lake, POSITIONED)
