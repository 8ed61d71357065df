"""Snapshots of operational tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Driver class and URL form of the source database.
SQLSERVER_DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"
SQLSERVER_URL = "jdbc:sqlserver://{server};databaseName={database};encrypt={encrypt}"


@dataclass(frozen=True)
class Split:
    """Parallel read by ranges of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def sqlserver_url(server: str, database: str, encrypt: bool = False) -> str:
    """``host,port`` and ``host:port`` are both accepted."""
    return SQLSERVER_URL.format(
        server=server.strip().replace(",", ":"),
        database=database.strip(),
        encrypt=str(encrypt).lower(),
    )


def key_ranges(column: str, bounds: Sequence[str]) -> list[str]:
    """Disjoint WHERE clauses covering every row, for keys that are text.

    ``bounds`` are ascending split points; rows below the first, from the last on, and with a
    NULL key are included, so nothing is lost whatever the points are.
    """
    if not bounds:
        return ["1 = 1"]
    quoted = ["'" + b.replace("'", "''") + "'" for b in bounds]
    ranges = [f"{column} < {quoted[0]} OR {column} IS NULL"]
    ranges += [f"{column} >= {lo} AND {column} < {hi}" for lo, hi in zip(quoted, quoted[1:])]
    return [*ranges, f"{column} >= {quoted[-1]}"]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    driver: str = SQLSERVER_DRIVER,
    split: Split | None = None,
    predicates: Sequence[str] | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """One table as a lazy DataFrame; filters and column pruning are pushed to the database.

    Without ``split`` or ``predicates`` the whole table goes through a single task, which suits
    small tables only. Credentials come in ``properties`` from the caller.
    """
    options = {"driver": driver, "fetchsize": "10000", **(properties or {})}
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    if split:
        options.update(split.options())
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()
