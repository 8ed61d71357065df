"""Change feed to bronze as one continuous query per table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from cdclake.operators.changes import (
    allow_tables,
    parse_envelopes,
    route,
    unwrap_changes,
    with_event_date,
)
from cdclake.sources.change_files import PARTITIONS, as_file_rows, table_path
from cdclake.specs import TableSpec

# Fixed value: how often the sink closes its files.
ROTATION = "60 seconds"


def topic_pattern(prefix: str, tables: Iterable[str]) -> str:
    """Regular expression over topic names ``<prefix>.<table>`` for the given tables."""
    return prefix.replace(".", r"\.") + r"\.(" + "|".join(tables) + ")"


def stream_changes(
    spark: SparkSession, fmt: str, options: Mapping[str, str], spec: TableSpec
) -> DataFrame:
    """Streaming envelopes of one table with their ``topic`` and arrival ``timestamp``.

    ``kafka`` reads message values as JSON and needs the connector on the class path
    (``subscribe``/``subscribePattern`` in ``options``). Any file format reads the envelopes from
    files under ``options["path"]``.
    """
    if fmt == "kafka":
        raw = (
            spark.readStream.format("kafka")
            .options(**{"startingOffsets": "earliest", **options})
            .load()
            .select("topic", "timestamp", "value")
        )
        return parse_envelopes(raw, spec)
    transport = [StructField("topic", StringType()), StructField("timestamp", TimestampType())]
    schema = StructType(list(spec.envelope_schema.fields) + transport)
    return spark.readStream.format(fmt).schema(schema).options(**options).load()


def flatten(envelopes: DataFrame, spec: TableSpec) -> DataFrame:
    """Route, filter to the table, unwrap to file types, and stamp the arrival day."""
    ours = allow_tables(route(envelopes), [spec.name])
    row = StructType([f for f in spec.file_schema if f.name in spec.columns])
    flat = with_event_date(unwrap_changes(ours, spec, row_schema=row), "timestamp")
    return flat.select(*spec.change_schema.fieldNames())


def write_changes(
    changes: DataFrame,
    root: str,
    spec: TableSpec,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    max_records: int | None = None,
) -> StreamingQuery:
    """Append a stream to the change files, by day and code, exactly once per checkpoint.

    There is no shuffle: every task writes the few days and codes it holds.
    """
    writer = (
        as_file_rows(changes, spec)
        .writeStream.format("parquet")
        .partitionBy(*PARTITIONS)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": ROTATION}))
    )
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    return writer.start(table_path(root, spec))


def stream_bronze(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    spec: TableSpec,
    root: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    max_records: int | None = None,
) -> StreamingQuery:
    """The capture path as one query: read, route, flatten, stamp, write."""
    changes = flatten(stream_changes(spark, fmt, options, spec), spec)
    return write_changes(changes, root, spec, checkpoint, trigger, max_records)
