"""Change records: routing, flattening, typing, and the latest change per key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions import event_day, op_rank, wire_to_lake
from cdclake.functions.columns import DELETE
from cdclake.specs import (
    CHANGE_FIELDS,
    DELETED,
    EVENT_DATE,
    OP,
    SOURCE_TS,
    TABLE,
    TableSpec,
)

# A topic is renamed by removing everything up to its first dot.
ROUTE_PATTERN = r"^[^.]+\.(.*)"
ROUTE_REPLACEMENT = "$1"


def route(df: DataFrame, topic_col: str = "topic") -> DataFrame:
    """Strip the server prefix from the topic name."""
    return df.withColumn(
        topic_col, F.regexp_replace(topic_col, ROUTE_PATTERN, ROUTE_REPLACEMENT)
    )


def allow_tables(df: DataFrame, tables: Iterable[str], topic_col: str = "topic") -> DataFrame:
    """Keep only changes whose topic ends in one of the named tables."""
    return df.where(F.substring_index(topic_col, ".", -1).isin(list(tables)))


def parse_envelopes(df: DataFrame, spec: TableSpec, value_col: str = "value") -> DataFrame:
    """JSON message bytes to envelope columns. A NULL value stays as an all-NULL envelope.

    A message that is not valid JSON stops the query: silently turning it into NULLs would
    lose a change.
    """
    envelope = F.from_json(F.col(value_col).cast("string"), spec.envelope_schema, {"mode": "FAILFAST"})
    rest = [c for c in df.columns if c != value_col]
    return df.select(*rest, envelope.alias("__envelope")).select(*rest, "__envelope.*")


def unwrap_changes(
    df: DataFrame,
    spec: TableSpec,
    drop_tombstones: bool = True,
    row_schema: T.StructType | None = None,
) -> DataFrame:
    """Flatten envelopes to rows plus ``__deleted, __op, __table, __source_ts_ms``.

    Inserts and updates take the ``after`` image. A delete keeps its ``before`` image and is
    marked ``__deleted = "true"``. Values take the types of ``row_schema``, by default those of
    the lake. Other columns (topic, arrival timestamp) pass through.
    """
    if drop_tombstones:
        df = df.where(F.col("before").isNotNull() | F.col("after").isNotNull())
    deleted = F.col("op").eqNullSafe(DELETE)
    image = F.when(deleted, F.col("before")).otherwise(F.col("after"))
    wire = df.schema["after"].dataType
    passthrough = [c for c in df.columns if c not in ("before", "after", "source", "op", "ts_ms")]
    return df.select(
        *[
            wire_to_lake(image[f.name], wire[f.name].dataType, f.dataType).alias(f.name)
            for f in row_schema or spec.schema
        ],
        F.when(deleted, "true").otherwise("false").alias(DELETED),
        F.col("op").alias(OP),
        F.coalesce(F.col("source.table"), F.lit(spec.name)).alias(TABLE),
        F.col("source.ts_ms").alias(SOURCE_TS),
        *passthrough,
    )


def with_event_date(df: DataFrame, ts_col: str) -> DataFrame:
    """Stamp the UTC arrival day as text. It is when the change arrived, not the business day."""
    return df.withColumn(EVENT_DATE, event_day(F.col(ts_col), df.schema[ts_col].dataType))


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast every column of ``spec`` present in ``df`` to its lake type; NULL for absent ones.

    A value that does not fit its type fails the query. Use :func:`split_unconvertible` to set
    such rows aside instead. Columns the spec does not know are kept as they are.
    """
    return _cast_to(df, spec.change_schema, strict=True)


def unconvertible(df: DataFrame, spec: TableSpec) -> Column:
    """Whether a row has a value that does not fit its type in the spec."""
    known = {f.name: f for f in spec.change_schema}
    misfits = [
        F.col(f.name).isNotNull()
        & wire_to_lake(F.col(f.name), f.dataType, known[f.name].dataType, strict=False).isNull()
        for f in df.schema
        if f.name in known and f.dataType != known[f.name].dataType
    ]
    return reduce(lambda a, b: a | b, misfits, F.lit(False))


def split_unconvertible(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the spec's types, rows with at least one value that does not)."""
    bad = unconvertible(df, spec)
    return _cast_to(df.where(~bad), spec.change_schema, strict=False), df.where(bad)


def _cast_to(df: DataFrame, schema: T.StructType, strict: bool) -> DataFrame:
    present = {f.name: f.dataType for f in df.schema}
    # A log may lack what only the capture adds; its schema then ends without it.
    required = set(schema.fieldNames()) - {f.name for f in CHANGE_FIELDS}
    columns = []
    for f in schema:
        if f.name in present:
            columns.append(
                wire_to_lake(F.col(f.name), present[f.name], f.dataType, strict).alias(f.name)
            )
        elif f.name in required:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c not in set(schema.fieldNames())]
    return df.select(*columns, *extra)


def project(df: DataFrame, spec: TableSpec, *extra: str) -> DataFrame:
    """The business columns of ``spec`` (and ``extra`` ones), in table order."""
    return df.select(*spec.columns, *extra)


def with_key(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.where(F.col(spec.pk).isNotNull())


def null_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Changes that no table row can be matched to; they never reach silver."""
    return df.where(F.col(spec.pk).isNull())


def null_ops(df: DataFrame) -> DataFrame:
    """Changes without a change code; a merge ignores them, this makes them countable."""
    return df.where(F.col(OP).isNull())


def precedence(
    spec: TableSpec, columns: Sequence[str], prefix: str = "", seq_col: str | None = None
) -> list[Column]:
    """What makes one change of a key newer than another, most significant first.

    Source time, then the log sequence if one was captured, then the change code, then the
    row's own version time, then the remaining values and what the capture added, so that no two distinct
    changes tie and the outcome never depends on row order. NULL is lowest throughout.
    """
    seq_col = seq_col or (spec.seq_column if spec.seq_column in columns else None)

    def col(name: str) -> Column:
        return F.col(f"{prefix}{name}")

    order = [col(SOURCE_TS)]
    if seq_col:
        order.append(col(seq_col))
    order.append(op_rank(col(OP)))
    first = {spec.pk, SOURCE_TS, seq_col}
    if spec.version_column in columns:
        order.append(col(spec.version_column))
        first.add(spec.version_column)
    order += [col(c) for c in (*spec.columns, EVENT_DATE, DELETED) if c in columns and c not in first]
    return order


def latest_per_key(changes: DataFrame, spec: TableSpec, seq_col: str | None = None) -> DataFrame:
    """The newest change of every key, deletes included; rows without a key are left out.

    The ``row_number() = 1`` form lets the optimizer keep one row per key and task before the
    shuffle, so a key that holds most of the log sends at most one row per map task.
    """
    newest_first = Window.partitionBy(spec.pk).orderBy(
        *[c.desc() for c in precedence(spec, changes.columns, seq_col=seq_col)]
    )
    return (
        with_key(changes, spec)
        .withColumn("__rn", F.row_number().over(newest_first))
        .where(F.col("__rn") == 1)
        .drop("__rn")
    )
