"""From a snapshot of a table to its log: what both tell is reconciled by log position, not by arrival.

The capture notes the log's position before it starts to read a table: the mark. Every row of the snapshot, whenever it
was read, is at least as new as the mark, and every change behind the mark is in the log. So snapshot rows
count as changes at the mark, changes up to the mark are left out, and the usual order decides the rest: a change
behind the mark beats the snapshot row, even if that was read after it and says the same, and even
if the change is handed in first. A snapshot read in chunks has one mark a chunk; its rows then carry their own.

The table needs a log sequence (``TableSpec.seq_column``).
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.functions import as_day
from cdclake.functions.columns import READ
from cdclake.specs import DELETED, EVENT_DATE, OP, SOURCE_TS, TABLE, TableSpec


@dataclass(frozen=True)
class Mark:
    """The log's position when the snapshot was begun, and the source time of the last change up to it."""

    position: int
    ts_ms: int

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Mark:
        return Mark(**json.loads(text))


def _sequence(spec: TableSpec) -> str:
    if not spec.seq_column:
        raise ValueError(f"{spec.name} has no log sequence to hand over by; set seq_column")
    return spec.seq_column


def snapshot_changes(
    rows: DataFrame,
    spec: TableSpec,
    mark: Mark,
    day: str | dt.date,
    position: Column | None = None,
    ts_ms: Column | None = None,
) -> DataFrame:
    """Rows of the table as changes at the mark, or at the marks of their chunks (``position`` and ``ts_ms``)."""
    seq = _sequence(spec)
    stamped = {
        DELETED: F.lit("false"),
        OP: F.lit(READ),
        TABLE: F.lit(spec.name),
        SOURCE_TS: (F.lit(mark.ts_ms) if ts_ms is None else ts_ms).cast("long"),
        seq: (F.lit(mark.position) if position is None else position).cast("long"),
        EVENT_DATE: F.lit(as_day(day).isoformat()),
    }
    return rows.select(*spec.columns, *[v.alias(k) for k, v in stamped.items()]).select(*spec.change_schema.fieldNames())


def tail(changes: DataFrame, spec: TableSpec, mark: Mark) -> DataFrame:
    """The changes behind the mark, of a batch or a stream; with chunks, the lowest mark.

    Up to the mark the snapshot tells all: a key that it lacks was deleted by then. Changes without a position
    are kept, as nothing says that the snapshot knows them.
    """
    seq = F.col(_sequence(spec))
    return changes.where(seq.isNull() | (seq > mark.position))
