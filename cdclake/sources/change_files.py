"""Raw change files: Parquet under ``<root>/<directory of the table>/event_date=…/__op=…``.

The directory is the table's name, or follows a template such as ``prefix.schema.{table}``, as a sink
that names directories by topic writes them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions import as_day
from cdclake.operators.changes import conform
from cdclake.specs import EVENT_DATE, OP, TableSpec

PARTITIONS = (EVENT_DATE, OP)


def table_path(root: str, spec: TableSpec, layout: str = "{table}") -> str:
    return f"{root.rstrip('/')}/{layout.format(table=spec.name)}"


def read_changes(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    days: str | dt.date | Iterable[str | dt.date] | None = None,
    merge_schema: bool = False,
    layout: str = "{table}",
    typed: bool = True,
    retyped: Iterable[T.StructField] = (),
) -> DataFrame:
    """Changes of one table that arrived on the given day(s), typed as bronze.

    Only the directories of those days are listed and read. The schema comes from the spec, so
    no footers are read to infer it, ``event_date`` stays text, columns missing from older files
    read as NULL and decimals that travelled as doubles are cast back. ``merge_schema`` instead
    takes the union of the files' own schemas, which also keeps columns the spec lacks. A day
    without a directory raises an AnalysisException. Without ``typed`` rows stay as the files have them;
    ``retyped`` are the columns that files have under another type than the spec says.
    """
    base = table_path(root, spec, layout)
    reader = spark.read.option("basePath", base)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    else:
        own = {f.name: f for f in retyped}
        reader = reader.schema(T.StructType([own.get(f.name, f) for f in spec.file_schema]))
    raw = reader.parquet(*_day_paths(base, days))
    if merge_schema:
        raw = raw.withColumn(EVENT_DATE, F.col(EVENT_DATE).cast("string"))
    return conform(raw, spec) if typed else raw


def _day_paths(base: str, days: str | dt.date | Iterable[str | dt.date] | None) -> list[str]:
    if days is None:
        return [base]
    days = [days] if isinstance(days, (str, dt.date)) else list(days)
    return [f"{base}/{EVENT_DATE}={as_day(d).isoformat()}" for d in days]


def found_schema(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    days: str | dt.date | Iterable[str | dt.date] | None = None,
    layout: str = "{table}",
) -> T.StructType:
    """The union of the files' own schemas. Footers are read by Spark's tasks, rows are not."""
    base = table_path(root, spec, layout)
    reader = spark.read.option("basePath", base).option("mergeSchema", True)
    return reader.parquet(*_day_paths(base, days)).schema


def as_file_rows(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Known columns in file types, any others behind them."""
    known = spec.file_schema
    extra = [c for c in changes.columns if c not in known.fieldNames()]
    return changes.select(*[F.col(f.name).cast(f.dataType) for f in known], *extra)


def write_change_files(
    changes: DataFrame,
    root: str,
    spec: TableSpec,
    mode: str = "append",
    max_records: int = 0,
    layout: str = "{table}",
    rebalance: bool = True,
) -> None:
    """Batch twin of the streaming file sink.

    The rebalance gives each (day, code) as many writers as its size calls for: small ones get
    one file, a day that holds most of the rows is split over several tasks. Without it there is no shuffle, as in the
    stream: every task writes the days and codes it holds, for changes of few days.
    """
    rows = as_file_rows(changes, spec)
    if rebalance:
        rows = rows.hint("rebalance", *PARTITIONS)
    writer = rows.write.mode(mode).partitionBy(*PARTITIONS)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(table_path(root, spec, layout))
