"""Folding changes into current rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.functions.columns import DELETE
from cdclake.operators.changes import latest_per_key, precedence, project
from cdclake.specs import OP, SOURCE_TS, TableSpec


def merge_changes(
    target: DataFrame, changes: DataFrame, spec: TableSpec, seq_col: str | None = None
) -> DataFrame:
    """``target`` after upserting and deleting by the latest change of each key.

    Matched and deleted: row removed. Matched otherwise: row replaced. Unmatched and not
    deleted: row added. Unmatched delete: nothing happens. Changes without a code are ignored, as everywhere in
    the library: the latest change that has one decides.
    Replacing every non-key column is the same as dropping the matched rows and adding the new
    ones, so one anti join does it: a change set that Spark knows to be small (files below the
    broadcast threshold) is broadcast and the target is neither shuffled nor sorted; any other is
    joined by shuffling the target once.
    """
    latest = latest_per_key(changes.where(F.col(OP).isNotNull()), spec, seq_col)
    untouched = target.join(latest.select(spec.pk), spec.pk, "left_anti")
    upserts = latest.where(F.col(OP) != DELETE)
    return project(untouched, spec).unionByName(project(upserts, spec))


def as_state(changes: DataFrame, spec: TableSpec, seq_col: str | None = None) -> DataFrame:
    """The state columns of changes that carry a code: table row, code, source time."""
    names = spec.state_schema.fieldNames()
    extra = [seq_col] if seq_col and seq_col not in names else []
    return changes.where(F.col(OP).isNotNull()).select(*names, *extra)


def merge_state(
    state: DataFrame,
    changes: DataFrame,
    spec: TableSpec,
    seq_col: str | None = None,
    buckets: int | None = None,
    oldest: int | None = None,
) -> DataFrame:
    """Fold changes into a state that remembers, per key, the change that produced it.

    A change wins only if it is not older than what the state holds, by the same precedence as
    :func:`latest_per_key`. Deletes stay as rows with code ``d`` so that a late, older change
    cannot bring a key back; :func:`current_rows` hides them. Hence replaying, reordering or
    splitting the changes leads to the same state.

    Both sides hold one row per key at the join, so it cannot fan out or skew. If the state is
    stored in ``buckets`` by key, it is read in place and only the latest changes are moved to
    its buckets, however many partitions a shuffle otherwise has.

    ``oldest`` is a source time in milliseconds before which no change may come any more. Then a delete from
    before it has nothing left to guard against and is forgotten, and changes from before it are left out, as
    they could bring back what was forgotten. The state grows with live rows and recent deletes only.
    """
    columns = state.columns
    if oldest is not None:
        changes = changes.where(~too_old(oldest))
    latest = latest_per_key(as_state(changes, spec, seq_col), spec, seq_col)
    if buckets:
        latest = latest.repartition(buckets, spec.pk)
    old = state.select(spec.pk, F.struct(*columns).alias("__old"))
    new = latest.select(spec.pk, F.struct(*columns).alias("__new"))
    age_old = F.struct(*precedence(spec, columns, "__old.", seq_col))
    age_new = F.struct(*precedence(spec, columns, "__new.", seq_col))
    keep_old = F.col("__new").isNull() | (F.col("__old").isNotNull() & (age_old > age_new))
    winner = F.when(keep_old, F.col("__old")).otherwise(F.col("__new"))
    merged = (
        old.join(new, spec.pk, "full_outer")
        .select(spec.pk, winner.alias("__row"))
        .select(spec.pk, *[F.col(f"__row.{c}").alias(c) for c in columns if c != spec.pk])
        .select(*columns)
    )
    return merged if oldest is None else merged.where((F.col(OP) != DELETE) | ~too_old(oldest))


def too_old(oldest: int) -> Column:
    """Whether a change is from before the oldest source time that is accepted; without a time it is."""
    return F.coalesce(F.col(SOURCE_TS) < oldest, F.lit(True))


def current_rows(state: DataFrame, spec: TableSpec) -> DataFrame:
    """The table a reader sees: live rows only, business columns only."""
    return project(state.where(F.col(OP) != DELETE), spec)
