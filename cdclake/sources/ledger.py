"""What silver was made from: the files of the log that were merged.

Both sides are tables of (path, length, modified). The log's side is the file system's listing, so no file is
opened and no row read to find out what is new; the other is written beside each silver snapshot and
published together with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.specs import EVENT_DATE

SCHEMA = f"path string, length bigint, modified timestamp, {EVENT_DATE} string"
#: Files that are read by name; beyond, the days that hold them are read whole, which gives the same result.
BY_NAME = 10_000


def location(spark: SparkSession, table: str) -> str:
    """Where a table keeps its files."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.first().data_type


def log_files(spark: SparkSession, table: str) -> DataFrame:
    """(path, length, modified, event_date) of the files of a table partitioned by arrival day."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location(spark, table))
    return files.select(
        "path",
        "length",
        F.col("modificationTime").alias("modified"),
        F.regexp_extract("path", f"/{EVENT_DATE}=([^/]*)/", 1).alias(EVENT_DATE),
    )


def unmerged(listed: DataFrame, merged: DataFrame | None) -> DataFrame:
    """Files that were not merged as they are now."""
    return listed if merged is None else listed.join(merged, ["path", "length", "modified"], "left_anti")


def read_files(spark: SparkSession, table: str, fresh: DataFrame, by_name: int = BY_NAME) -> tuple[DataFrame, int]:
    """The rows of the given files of a table, and the number of arrival days they belong to."""
    scan = spark.table(table)
    # One row for each arrival day.
    days = [r[EVENT_DATE] for r in fresh.select(EVENT_DATE).distinct().collect()]
    paths = [r.path for r in fresh.select("path").limit(by_name + 1).collect()]
    if len(paths) > by_name:
        return scan.where(F.col(EVENT_DATE).isin(sorted(days))), len(days)
    if not paths:
        return scan.where(F.lit(False)), 0
    provider = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Provider'").first().data_type
    reader = spark.read.format(provider).schema(scan.schema).option("basePath", location(spark, table))
    return reader.load(sorted(paths)).select(*scan.columns), len(days)
