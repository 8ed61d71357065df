"""Lakes built from the test tables, shared by the queries of one Spark application."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.plans.jobs import run_bronze, run_gold, run_silver
from cdclake.plans.session import MB
from cdclake.sources.change_files import write_change_files
from cdclake.sources.lake import Lake, create_layers, init_namespaces
from cdclake.sources.lake import fresh_dir as shared_folder
from suite import bindings as b

_BUILT: dict[tuple, object] = {}

# A bucket of a state is sorted in memory by one task; rows take some ten times their size in the test tables' files, and
# forty times where these compress well.
BUCKET_BYTES = 12 * MB
# What a task of a load takes in; a write by partitions sorts its rows, wider and not compressed.
TASK_BYTES = "16m"
_SMALL_TASKS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
    "spark.sql.files.maxPartitionBytes": TASK_BYTES,
}
FEED_TABLES = ("customer", "events", "lineitem", "orders")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder where the cluster says; on one machine, where nothing is set, a temporary one."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
    return shared_folder(spark, label)


def once(spark: SparkSession, sf: str, what: str, build):
    """Build a fixture at most once per application, scale and kind."""
    key = (spark.sparkContext.applicationId, sf, what)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def state_buckets(spark: SparkSession, sf: str, names: tuple[str, ...] = FEED_TABLES) -> int:
    """Buckets by the size of the tables that a lake is built from, so that a bucket does not grow with them."""
    size = 0
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf}/{name}.parquet")
        size += path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(8, -(-size // BUCKET_BYTES))


@contextmanager
def _set_for(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def small_tasks(spark: SparkSession):
    """Settings for writes by partitions, whose tasks then sort their rows in memory."""
    return _set_for(spark, _SMALL_TASKS)


def sized_for(spark: SparkSession, buckets: int):
    """Settings for a load: shuffles as wide as a state has buckets, so that a merge moves its changes once, straight to
    the key's bucket; tasks whose rows a partitioned write sorts in memory; smaller files, with times as 64-bit numbers;
    few days and codes at a time, which a task writes side by side without sorting; some fifty files of a state to a task
    that reads it, as there is a small one for each month and bucket."""
    width = {
        "spark.sql.shuffle.partitions": str(buckets),
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
        "spark.sql.maxConcurrentOutputFileWriters": "8",
        "spark.sql.files.openCostInBytes": "256k",
    }
    return _set_for(spark, width | _SMALL_TASKS)


def empty_lake(spark: SparkSession, label: str, buckets: int = 8) -> Lake:
    lake = Lake(
        spark,
        root=fresh_dir(spark, f"lake-{label}"),
        prefix=f"cdc_{label}_{uuid.uuid4().hex[:8]}_",
        state_buckets=buckets,
    )
    init_namespaces(lake)
    return lake


def feed_files(spark: SparkSession, sf: str) -> str:
    """Raw change files of all six entities, two arrival days."""

    def build() -> str:
        root = fresh_dir(spark, "feed")
        with sized_for(spark, max(state_buckets(spark, sf), int(spark.conf.get("spark.sql.shuffle.partitions")))):
            # Bookings and payments both follow the orders' lines, which are moved once.
            orders = fresh_dir(spark, "orders-now")
            b.orders_now(spark, sf).write.parquet(orders)
            now = spark.read.parquet(orders)
            for name, spec in b.SPECS.items():
                # Two days: tasks write what they hold.
                write_change_files(b.feed(spark, sf, name, now), root, spec, rebalance=False)
        return root

    return once(spark, sf, "feed", build)


def loaded_lake(spark: SparkSession, sf: str) -> Lake:
    """Bronze, silver and gold after both days went through the jobs, day by day."""

    def build() -> Lake:
        root = feed_files(spark, sf)
        lake = empty_lake(spark, "loaded", state_buckets(spark, sf))
        with sized_for(spark, lake.state_buckets):
            create_layers(lake, b.SPECS.values())
            for day in (b.DAY_1, b.DAY_2):
                run_bronze(lake, root, day, specs=b.SPECS)
                run_silver(lake, since=day, specs=b.SPECS)
            run_gold(lake, specs=b.SPECS)
        return lake

    return once(spark, sf, "loaded", build)


def user_files(spark: SparkSession, sf: str) -> str:
    """The user change log as change files, one directory per day and code."""

    def build() -> str:
        root = fresh_dir(spark, "user-log")
        write_change_files(b.change_log(spark, sf), root, b.USER_LOG)
        return root

    return once(spark, sf, "user-log", build)


def envelope_files(spark: SparkSession, sf: str) -> str:
    """Event envelopes as JSON lines, the form a message broker would deliver them in."""

    def build() -> str:
        path = fresh_dir(spark, "envelopes")
        b.envelopes(spark, sf).write.json(path)
        return path

    return once(spark, sf, "envelopes", build)


def plain(df: DataFrame) -> DataFrame:
    """Zoned timestamps as local ones, which is what the test tables and the oracle have."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast(T.TimestampNTZType()) for c in zoned})
