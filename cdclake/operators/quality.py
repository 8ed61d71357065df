"""Source constraints as checks over lake tables, which do not enforce them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.operators.reconcile import duplicates
from cdclake.specs import TableSpec


def check_pk(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Key values that break the primary key: repeated ones, and NULL however rare."""
    return (
        df.groupBy(spec.pk)
        .agg(F.count("*").alias("occurrence"))
        .where((F.col("occurrence") > 1) | F.col(spec.pk).isNull())
    )


def check_unique(df: DataFrame, *columns: str) -> DataFrame:
    return duplicates(df, *columns)


def check_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, null_count) for every column, counted in one pass over the table."""
    columns = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_count")


def check_domain(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Rows whose value is outside the domain. NULL passes, as in a SQL CHECK."""
    return df.where(~F.col(column).isin(list(values)))


def domain_violations(df: DataFrame, domains: Mapping[str, Iterable[str]]) -> DataFrame:
    """(column_name, violations) for several domains in one pass."""
    counts = df.agg(
        *[F.count_if(~F.col(c).isin(list(values))).alias(c) for c, values in domains.items()]
    )
    return counts.unpivot([], list(domains), "column_name", "violations")


def check_fk(
    child: DataFrame, parent: DataFrame, columns: tuple[str, str], n: str = "child_rows"
) -> DataFrame:
    """Foreign key values without a parent row and how many child rows carry each.

    Both sides are reduced to distinct keys by a partial aggregate before the shuffle, so
    neither a value shared by most children nor a repeated parent reaches one task in full. The
    aggregates leave both sides partitioned the way the join needs them.
    """
    fk, pk = columns
    values = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias(n))
    keys = parent.select(F.col(pk).alias(fk)).where(F.col(fk).isNotNull()).distinct()
    return values.join(keys, fk, "left_anti")


def apply_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Fill declared constant defaults. Timestamps are left as they came."""
    return df.withColumns(
        {c: F.coalesce(c, F.lit(v)) for c, v in spec.defaults.items() if c in df.columns}
    )
