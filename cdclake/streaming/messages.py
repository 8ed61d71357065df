"""One stream for all tables: messages of mixed topics to one sink, what cannot be read aside.

One query with one checkpoint reads every topic. Each message goes, with its place in the topic, to the
directory of its table, its payload parsed once into a VARIANT, or to the dead letters with its raw text
and the reason. Both are parts of one file sink, so a batch commits its changes and its dead letters together, exactly
once, and a malformed message stops nothing. Readers give a table's payloads their types.

`capture.stream_bronze` is the strict form: one table, and a malformed message fails the query.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cdclake.functions.columns import DELETE
from cdclake.operators.changes import route, unwrap_changes, with_event_date
from cdclake.specs import EVENT_DATE, TableSpec
from cdclake.streaming.capture import ROTATION

SINK, DEAD = "__sink", "dead_letters"
MESSAGE = "topic string, partition int, offset bigint, timestamp timestamp, value string"
_STORED = (
    "topic string, partition int, offset bigint, timestamp timestamp, payload variant, raw string, reason string, "
    f"{SINK} string, {EVENT_DATE} string"
)
#: Why a message is a dead letter.
REASONS = ("table", "json", "type", "code", "image")


def stream_messages(spark: SparkSession, fmt: str, options: Mapping[str, str]) -> DataFrame:
    """Messages with their topic and place. ``kafka`` needs the connector; file formats hold MESSAGE's columns."""
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**{"startingOffsets": "earliest", **options}).load()
        return raw.select("topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))
    return spark.readStream.format(fmt).schema(MESSAGE).options(**options).load()


def _misfit(spec: TableSpec) -> Column:
    """Whether a message that is JSON has a value of another type than the table's envelope."""
    schema = T.StructType(list(spec.envelope_schema)).add("__misfit", "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__misfit"}
    return F.from_json("value", schema, options)["__misfit"].isNotNull()


def sort_messages(messages: DataFrame, specs: Iterable[TableSpec]) -> DataFrame:
    """Each message with the sink it belongs to, and for dead letters the reason, the first of REASONS that holds.

    Empty messages, which follow deletes so that brokers can compact, are dropped.
    """
    specs = list(specs)
    misfit = F.lit(False)
    for spec in specs:  # one branch a row is evaluated
        misfit = F.when(F.col("__table") == spec.name, _misfit(spec)).otherwise(misfit)
    code = F.try_variant_get("payload", "$.op", "string")
    image = F.when(code == DELETE, F.try_variant_get("payload", "$.before", "variant")).otherwise(
        F.try_variant_get("payload", "$.after", "variant")
    )
    reason = (
        F.when(~F.col("__table").isin([s.name for s in specs]), "table")
        .when(F.col("payload").isNull() | ~F.schema_of_variant("payload").startswith("OBJECT"), "json")
        .when(misfit, "type")
        .when(code.isNull(), "code")
        .when(image.isNull() | F.is_variant_null(image), "image")
    )
    sorted_ = (
        route(messages.where(F.col("value").isNotNull()).withColumn("__table", F.col("topic")), "__table")
        .withColumn("__table", F.substring_index("__table", ".", -1))
        .withColumn("payload", F.try_parse_json("value"))
        .withColumn("reason", reason)
        .withColumn(SINK, F.when(F.col("reason").isNull(), F.col("__table")).otherwise(DEAD))
    )
    dead = F.col("reason").isNotNull()
    return with_event_date(sorted_, "timestamp").select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.when(~dead, F.col("payload")).alias("payload"),
        F.when(dead, F.col("value")).alias("raw"),
        "reason",
        SINK,
        EVENT_DATE,
    )


def capture_all(
    messages: DataFrame,
    specs: Iterable[TableSpec],
    root: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Sort a stream of messages into the sink at ``root``. There is no shuffle."""
    return (
        sort_messages(messages, specs)
        .writeStream.format("parquet")
        .partitionBy(SINK, EVENT_DATE)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": ROTATION}))
        .start(root)
    )


def _captured(spark: SparkSession, root: str) -> DataFrame:
    """The sink's committed files; those of batches that failed are not seen."""
    return spark.read.schema(_STORED).parquet(root)


def captured_changes(
    spark: SparkSession, root: str, spec: TableSpec, days: Iterable[str] | None = None
) -> DataFrame:
    """The changes of one table, flattened and typed as bronze; ``days`` are arrival days to read."""
    rows = _captured(spark, root).where(F.col(SINK) == spec.name)
    if days is not None:
        rows = rows.where(F.col(EVENT_DATE).isin(list(days)))
    envelope = F.col("payload").cast(spec.envelope_schema)
    flat = unwrap_changes(rows.select(envelope.alias("e"), EVENT_DATE).select("e.*", EVENT_DATE), spec)
    return flat.select(*spec.change_schema.fieldNames())


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """(topic, partition, offset, timestamp, raw, reason, event_date) of the messages set aside."""
    rows = _captured(spark, root).where(F.col(SINK) == DEAD)
    return rows.select("topic", "partition", "offset", "timestamp", "raw", "reason", EVENT_DATE)
