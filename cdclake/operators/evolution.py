"""How the schema of change files may differ from the one a table is known by."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from cdclake.specs import CHANGE_FIELDS, TableSpec

#: What a load does about columns it does not know: leave them out and say so, widen the log, or stop.
NEW_COLUMNS = ("report", "widen", "refuse")


class IncompatibleSchema(ValueError):
    """Change files that cannot be loaded under the table's schema; nothing was written."""


@dataclass(frozen=True)
class SchemaDiff:
    """``added``: columns that only the files have. ``retyped``: known columns as the files have them, where
    that converts without loss. ``conflicts``: everything that does not, in words."""

    added: tuple[T.StructField, ...] = ()
    retyped: tuple[T.StructField, ...] = ()
    conflicts: tuple[str, ...] = ()


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is one of ``new``."""
    whole = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    if type(old) in whole and type(new) in whole:
        return whole.index(type(old)) <= whole.index(type(new))
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return old.scale <= new.scale and old.precision - old.scale <= new.precision - new.scale
    if isinstance(old, T.FloatType) and isinstance(new, T.DoubleType):
        return True
    if isinstance(old, T.DateType) and isinstance(new, (T.TimestampType, T.TimestampNTZType)):
        return True
    return old == new


def schema_diff(found: T.StructType, spec: TableSpec) -> SchemaDiff:
    """The files' schema against the spec's.

    Columns that files lack read as NULL, but the key must be there. Names that start with ``__`` belong to
    the capture and are no columns of the table. Names are compared as Spark does, without case.
    """
    captured = {f.name.lower() for f in CHANGE_FIELDS}
    expected = {f.name.lower(): f for f in spec.file_schema}
    lake = {f.name.lower(): f.dataType for f in spec.change_schema}
    added, retyped, conflicts = [], [], []
    for f in found:
        name = f.name.lower()
        if name in captured or (name.startswith("__") and name not in expected):
            continue
        if name not in expected:
            added.append(T.StructField(f.name, f.dataType))
        elif f.dataType != expected[name].dataType and not _same_time(f.dataType, expected[name].dataType):
            if widens(f.dataType, lake[name]) or widens(f.dataType, expected[name].dataType):
                retyped.append(T.StructField(expected[name].name, f.dataType))
            else:
                conflicts.append(f"{f.name} is {f.dataType.simpleString()}, not {lake[name].simpleString()}")
    if spec.pk.lower() not in {f.name.lower() for f in found}:
        conflicts.append(f"the key {spec.pk} is missing")
    return SchemaDiff(tuple(added), tuple(retyped), tuple(conflicts))


def _same_time(a: T.DataType, b: T.DataType) -> bool:
    """Zoned and local timestamps: files tell them apart, the reader takes either."""
    times = (T.TimestampType, T.TimestampNTZType)
    return isinstance(a, times) and isinstance(b, times)
