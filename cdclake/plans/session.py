"""Session settings that depend on how much data a job moves."""

from __future__ import annotations

from pyspark.sql import SparkSession

MB = 1024 * 1024


def settings(
    shuffle_bytes: int, cores: int, partition_mb: int = 192, max_partitions: int | None = None
) -> dict[str, str]:
    """Spark settings for a job whose widest stage shuffles ``shuffle_bytes``.

    That is the bytes left after column pruning, filters and partial aggregation, not the size of
    the table. Adaptive execution merges small partitions and splits skewed ones at run time.
    The session time zone is UTC, as arrival days are. ``max_partitions`` bounds the bookkeeping of very wide
    shuffles, at the price of larger partitions.
    """
    wanted = max(cores, -(-shuffle_bytes // (partition_mb * MB)))
    if max_partitions is not None:
        wanted = min(wanted, max_partitions)
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        "spark.sql.shuffle.partitions": str(wanted),
    }


def build_session(app: str, shuffle_bytes: int, cores: int, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**settings(shuffle_bytes, cores), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
