"""Silver in a V2 catalog whose tables take row-level commands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.functions.columns import DELETE
from cdclake.operators.changes import latest_per_key, precedence
from cdclake.operators.merge import as_state
from cdclake.specs import OP, TableSpec


def merge_into(table: str, changes: DataFrame, spec: TableSpec, seq_col: str | None = None) -> None:
    """MERGE the latest change of each key into ``table``; Spark rewrites only what it touches.

    Changes without a code are ignored: the latest that has one decides.
    """
    latest = latest_per_key(changes.where(F.col(OP).isNotNull()), spec, seq_col).alias("s")
    source_op = F.col(f"s.{OP}")
    values = {c: F.col(f"s.{c}") for c in spec.columns}
    updates = {c: v for c, v in values.items() if c != spec.pk}
    (
        latest.mergeInto(table, F.col(f"{table}.{spec.pk}") == F.col(f"s.{spec.pk}"))
        .whenMatched(source_op == DELETE)
        .delete()
        .whenMatched(source_op != DELETE)
        .update(updates)
        .whenNotMatched(source_op != DELETE)
        .insert(values)
        .merge()
    )


def merge_state_into(
    table: str, changes: DataFrame, spec: TableSpec, seq_col: str | None = None
) -> None:
    """MERGE into a state table that keeps the change behind each row, deletes included.

    A change wins only if it is not older than what the table holds, so late or repeated batches
    do no harm; a delete updates its row to a tombstone instead of removing it.
    """
    latest = latest_per_key(as_state(changes, spec, seq_col), spec, seq_col).alias("s")
    columns = latest.columns
    age_new = F.struct(*precedence(spec, columns, "s.", seq_col))
    age_old = F.struct(*precedence(spec, columns, f"{table}.", seq_col))
    values = {c: F.col(f"s.{c}") for c in columns}
    updates = {c: v for c, v in values.items() if c != spec.pk}
    (
        latest.mergeInto(table, F.col(f"{table}.{spec.pk}") == F.col(f"s.{spec.pk}"))
        .whenMatched(age_new >= age_old)
        .update(updates)
        .whenNotMatched()
        .insert(values)
        .merge()
    )
