"""Comparing a source table with its silver copy."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.functions import coalesce_zero, differs, on_day
from cdclake.specs import TableSpec

Pairs = Mapping[str, tuple[DataFrame, DataFrame]]


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def count_reconciliation(pairs: Pairs) -> DataFrame:
    """Rows of source and silver per table and their signed difference (silver - source).

    Each side is counted once; the one-row counts are then added up per table, so no join is
    needed to put the two numbers side by side.
    """
    sides = []
    for table, (source, silver) in pairs.items():
        for frame, is_source in ((source, True), (silver, False)):
            n = frame.agg(F.count("*").alias("n"))
            zero = F.lit(0).cast("long")
            sides.append(
                n.select(
                    F.lit(table).alias("table_name"),
                    (F.col("n") if is_source else zero).alias("source_count"),
                    (zero if is_source else F.col("n")).alias("silver_count"),
                )
            )
    return (
        union_all(sides)
        .groupBy("table_name")
        .agg(F.sum("source_count").alias("source_count"), F.sum("silver_count").alias("silver_count"))
        .withColumn("difference", F.col("silver_count") - F.col("source_count"))
    )


def table_profile(pairs: Pairs, specs: Mapping[str, TableSpec]) -> DataFrame:
    """source_count, silver_count and duplicated_keys of silver per table, each side read once.

    Silver is bucketed by key, so counting its keys moves nothing; its rows are the sum of those counts.
    """
    sides = []
    for table, (source, silver) in pairs.items():
        keys = silver.groupBy(specs[table].pk).agg(F.count("*").alias("n"))
        zero = F.lit(0).cast("long")
        sides.append(source.agg(F.count("*").alias("source_count"), zero.alias("silver_count"), zero.alias("duplicated_keys")))
        sides.append(
            keys.agg(
                zero.alias("source_count"),
                coalesce_zero(F.sum("n")).alias("silver_count"),
                F.count_if(F.col("n") > 1).alias("duplicated_keys"),
            )
        )
        sides[-2:] = [side.withColumn("table_name", F.lit(table)) for side in sides[-2:]]
    numbers = ("source_count", "silver_count", "duplicated_keys")
    return union_all(sides).groupBy("table_name").agg(*[F.sum(c).alias(c) for c in numbers])


def duplicates(df: DataFrame, *columns: str) -> DataFrame:
    """Values of ``columns`` that occur more than once, with their ``occurrence``."""
    return df.groupBy(*columns).agg(F.count("*").alias("occurrence")).where("occurrence > 1")


def pk_duplicates(df: DataFrame, spec: TableSpec) -> DataFrame:
    return duplicates(df, spec.pk)


def duplicate_summary(tables: Mapping[str, tuple[DataFrame, TableSpec]]) -> DataFrame:
    """Number of duplicated keys per table; zero everywhere means the tables are clean."""
    return union_all(
        pk_duplicates(df, spec)
        .agg(F.count("*").alias("duplicated_keys"))
        .select(F.lit(table).alias("table_name"), "duplicated_keys")
        for table, (df, spec) in tables.items()
    )


def state_mismatch(
    source: DataFrame,
    silver: DataFrame,
    spec: TableSpec,
    column: str | None = None,
    names: tuple[str, str] = ("src_status", "target_status"),
    null_safe: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Keys present on both sides whose status differs.

    Each side is first reduced to distinct (key, status) with a row count, so a key repeated
    many times on both sides yields one row per status pair instead of every pair of rows;
    ``pair_count`` is the number of row pairs behind it (1 when keys are unique). With
    ``null_safe`` a NULL against a value is reported too. ``unique`` says that one side has each key once, as
    silver does: the sides are then joined on the key as they are, which moves each of them once at most, and only
    the mismatches are grouped. The result is the same.
    """
    column = column or spec.status_column
    src_name, tgt_name = names

    def statuses(df: DataFrame, status: str, n: str) -> DataFrame:
        keyed = df.where(F.col(spec.pk).isNotNull())
        return keyed.groupBy(spec.pk, F.col(column).alias(status)).agg(F.count("*").alias(n))

    if unique:
        sides = [
            df.where(F.col(spec.pk).isNotNull()).select(spec.pk, F.col(column).alias(name))
            for df, name in ((source, src_name), (silver, tgt_name))
        ]
        differing = sides[0].join(sides[1], spec.pk).where(differs(F.col(src_name), F.col(tgt_name), null_safe))
        return differing.groupBy(spec.pk, src_name, tgt_name).agg(F.count("*").alias("pair_count"))
    return (
        statuses(source, src_name, "__s")
        .join(statuses(silver, tgt_name, "__t"), spec.pk)
        .where(differs(F.col(src_name), F.col(tgt_name), null_safe))
        .select(spec.pk, src_name, tgt_name, (F.col("__s") * F.col("__t")).alias("pair_count"))
    )


def count_diff_by(
    source: DataFrame,
    silver: DataFrame,
    key: str,
    day: str | dt.date | None = None,
    ts_col: str = "created_at",
    null_safe: bool = False,
) -> DataFrame:
    """Row counts per value of ``key`` on both sides, zero-filled, with their difference.

    A NULL value of ``key`` matches nothing and so gives one row per side, unless ``null_safe``.
    """

    def per_key(df: DataFrame, side: str) -> DataFrame:
        if day is not None:
            df = df.where(on_day(F.col(ts_col), day))
        counted = df.groupBy(key).agg(F.count("*").alias("rows"))
        return counted.withColumnRenamed(key, "key").alias(side)

    keys = F.col("source.key"), F.col("silver.key")
    matched = keys[0].eqNullSafe(keys[1]) if null_safe else keys[0] == keys[1]
    return (
        per_key(source, "source")
        .join(per_key(silver, "silver"), matched, "full_outer")
        .select(
            F.coalesce(*keys).alias(key),
            coalesce_zero(F.col("source.rows")).alias("source_count"),
            coalesce_zero(F.col("silver.rows")).alias("silver_count"),
        )
        .withColumn("difference", F.col("silver_count") - F.col("source_count"))
    )


def event_total(
    source: DataFrame, silver: DataFrame, day: str | dt.date, ts_col: str = "created_at"
) -> DataFrame:
    """One row: rows of the day on either side, their absolute gap and a verdict."""
    pair = {"day": tuple(df.where(on_day(F.col(ts_col), day)) for df in (source, silver))}
    return count_reconciliation(pair).select(
        "source_count",
        "silver_count",
        F.abs("difference").alias("gap"),
        verdict(F.col("difference") == 0, "WARNING").alias("status"),
    )


def verdict(is_ok, otherwise: str):
    return F.when(is_ok, "OK").otherwise(otherwise)


def sample_violations(df: DataFrame, *order: str, n: int = 5) -> DataFrame:
    """The first ``n`` offenders in a fixed order, for a report."""
    return df.orderBy(*order).limit(n)
