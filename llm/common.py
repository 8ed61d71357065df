"""Shared scratch tables, sizes and Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from typing import ClassVar

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step inside a task works on; a single longer text is a step of its own.
STEP_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in spark.checkpoint.dir.

    Only where that is unset and everything runs in one process, as in tests, a temporary folder takes its place.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


class Scratch:
    """Tables of one run in the shared folder. A table cuts lineage and outlives lost executors.

    Results read them lazily, so they stay until `release`, to be called when results are written.
    """

    open: ClassVar[list[Scratch]] = []

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
        self.written = 0
        Scratch.open.append(self)

    def table(self, df: DataFrame, codec: str = "snappy") -> DataFrame:
        self.written += 1
        at = f"{self.path}/{self.written}"
        df.write.option("compression", codec).parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def drop(self) -> None:
        """Remove this run's tables."""
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(fs_path, True)


def release() -> None:
    """Remove the tables of all runs so far."""
    while Scratch.open:
        Scratch.open.pop().drop()


def give_back() -> None:
    """Return freed memory to the system. Workers outlive their tasks, and what they keep others lack."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def one_thread() -> None:
    """Keep matrix products of this worker in one thread.

    A task has one core. Spark lets numpy's library start as many threads as the executor has cores; on products as small
    as a minibatch's they wait for each other at full speed, which doubles the CPU time and gains nothing.
    """
    with contextlib.suppress(OSError):  # not every system lists what is loaded
        with open("/proc/self/maps") as maps:
            paths = {line.split(None, 5)[5].strip() for line in maps if "openblas" in line}
        for path in paths:
            library = ctypes.CDLL(path)
            for prefix in ("", "scipy_"):
                for suffix in ("", "64_"):
                    with contextlib.suppress(AttributeError):  # names differ between builds
                        library[f"{prefix}openblas_set_num_threads{suffix}"](1)


def steps(batches: Iterator[pa.RecordBatch], most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about so many bytes of text, so that memory doesn't follow batch sizes."""
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(
            zero_copy_only=False
        )
        first, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += size
        yield batch.slice(first)
        del batch
    give_back()



def partitions_for(rows: int, per_task: int) -> int:
    return max(1, -(-rows // per_task))


def most_frequent(counts: DataFrame, most: int, least: int = 1) -> pa.Table:
    """The rows of the largest n, at most `most` of them and none below `least`, collected.

    The limit for n comes from a histogram over 32nds of powers of two, a few thousand numbers at most, so that no
    task has to sort what all others bring.
    """
    level = F.floor(F.log2(F.col("n")) * 32).cast("int").alias("level")
    rows = counts.filter(F.col("n") >= least).groupBy(level).agg(F.count("*").alias("rows")).collect()
    held, limit = 0, None
    for row in sorted(rows, key=lambda r: -r["level"]):
        held += row["rows"]
        if held > most:
            break
        limit = row["level"]
    chosen = F.lit(False) if limit is None else (F.col("n") >= least) & (level >= limit)
    return counts.filter(chosen).toArrow()


def crc_mod(column: str, modulus: int):
    """crc32 of the id as text, modulo; the rule that holds documents out."""
    return F.crc32(F.col(column).cast("string")) % modulus
