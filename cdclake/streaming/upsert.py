"""Change stream to silver."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cdclake.operators.changes import conform
from cdclake.sources.change_files import table_path
from cdclake.sources.lake import Lake, apply_changes
from cdclake.specs import TableSpec


def stream_change_files(spark: SparkSession, root: str, spec: TableSpec, **options: str) -> DataFrame:
    """Change files as they arrive, typed as bronze."""
    raw = (
        spark.readStream.schema(spec.file_schema)
        .options(**options)
        .parquet(table_path(root, spec))
    )
    return conform(raw, spec)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint; one started on a new checkpoint has another."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"]


def stream_silver(
    changes: DataFrame,
    spec: TableSpec,
    lake: Lake,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Merge each micro-batch into silver.

    A batch's id is published together with its rows, so a batch that is replayed after a failure is either not
    there at all, or known and skipped without a merge. Where ids are not kept, in a V2 catalog, a replay
    changes nothing either, because the merge only lets newer changes win. With Parquet snapshots every batch writes the table anew, so only ``availableNow`` and
    ``once`` triggers are taken there; frequent small batches need a row-level catalog.
    """
    if not lake.catalog and trigger and not ({"availableNow", "once"} & set(trigger)):
        raise ValueError("Parquet silver is rewritten by every batch; use availableNow or a row-level catalog")

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        apply_changes(lake, batch, spec, batch=(query_id(lake.spark, checkpoint), batch_id))

    return (
        changes.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
