"""Column expressions shared by the operators. All of them stay inside generated JVM code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Change codes (snapshot read, insert, update, delete).
READ, CREATE, UPDATE, DELETE = "r", "c", "u", "d"


def as_day(day: str | dt.date) -> dt.date:
    """A calendar day from ``YYYY-MM-DD``; anything malformed raises before a query is built."""
    if isinstance(day, dt.datetime):
        return day.date()
    if isinstance(day, dt.date):
        return day
    return dt.date.fromisoformat(day)


def on_day(column: Column, day: str | dt.date) -> Column:
    """Half-open day range, so the predicate reaches the file scan (a cast on the column would not)."""
    start = as_day(day)
    return (column >= F.lit(start)) & (column < F.lit(start + dt.timedelta(days=1)))


def event_day(column: Column, data_type: T.DataType) -> Column:
    """UTC arrival day as ``yyyy-MM-dd``, independent of the session time zone."""
    if isinstance(data_type, T.TimestampNTZType):
        day = column.cast("date")
    elif isinstance(data_type, T.TimestampType):
        day = _utc_day(F.unix_millis(column))
    else:
        day = _utc_day(column)
    return day.cast("string")


def _utc_day(epoch_ms: Column) -> Column:
    return F.date_from_unix_date(F.floor(epoch_ms / F.lit(86_400_000)).cast("int"))


def op_rank(op: Column) -> Column:
    """Order of change codes within one source time: read < create < update < delete."""
    return (
        F.when(op == READ, 0)
        .when(op == CREATE, 1)
        .when(op == DELETE, 3)
        .when(op.isNotNull(), 2)
    )


def wire_to_lake(column: Column, wire: T.DataType, lake: T.DataType, strict: bool = True) -> Column:
    """Bring one value from its transport type to its lake type.

    ``strict`` fails on a value that does not fit; otherwise such a value becomes NULL so the
    caller can quarantine the row.
    """
    if wire == lake:
        return column
    if isinstance(wire, T.LongType) and isinstance(lake, (T.TimestampType, T.TimestampNTZType)):
        column = F.timestamp_millis(column)
    elif isinstance(wire, T.IntegerType) and isinstance(lake, T.DateType):
        return F.date_from_unix_date(column)
    return column.cast(lake) if strict else column.try_cast(lake)


def differs(left: Column, right: Column, null_safe: bool = False) -> Column:
    """Inequality; by default NULL on either side is not a difference, as in SQL ``!=``."""
    return ~left.eqNullSafe(right) if null_safe else left != right


def case_flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / whole


def coalesce_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def to_money_total(column: Column) -> Column:
    return column.cast(T.DecimalType(16, 2))
