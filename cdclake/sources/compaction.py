"""Closed days of the log in few files instead of many small ones.

Streams and frequent loads leave many small files a day. A closed day is written anew, in files of about a given
size, and takes the old files' place. What silver has merged stays known: if all files of a day were merged, the
new ones are recorded as merged in the same step; if not, the day is left as it is until they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import functions as F

from cdclake.functions import as_day
from cdclake.sources.lake import Lake, logged_spec, merged_files, record_files, remove_dir
from cdclake.sources.ledger import log_files, unmerged
from cdclake.specs import EVENT_DATE, TableSpec

#: Bytes of a file that readers like, and how many smaller files a day may hold before it is written anew.
TARGET_BYTES, MOST_SMALL = 256 << 20, 4


def crowded_days(lake: Lake, spec: TableSpec, target_bytes: int = TARGET_BYTES, most_small: int = MOST_SMALL):
    """(event_date, files, bytes) of days whose files are all merged and more than ``most_small`` too small."""
    listed, merged = log_files(lake.spark, lake.bronze(spec)), merged_files(lake, spec)
    small = F.count_if(F.col("length") < target_bytes // 2)
    days = listed.groupBy(EVENT_DATE).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), small.alias("small"))
    days = days.where(F.col("small") > most_small).drop("small")
    return days.join(unmerged(listed, merged).select(EVENT_DATE).distinct(), EVENT_DATE, "left_anti")


def compact(
    lake: Lake,
    spec: TableSpec,
    before: str | dt.date,
    days: Iterable[str | dt.date] | None = None,
    target_bytes: int = TARGET_BYTES,
    most_small: int = MOST_SMALL,
) -> list[str]:
    """Write crowded days before the day ``before`` anew; the days that were are returned.

    The rows are first copied beside the log, so the day is complete in one place or the other at any
    time. An attempt that fails before the exchange changes nothing and can be repeated. One that fails
    between the exchange and the record leaves a day that the next merge reads once more, which changes no row.
    """
    if lake.catalog:
        raise ValueError("V2 catalogs have compaction of their own")
    spark, table = lake.spark, lake.bronze(spec)
    spec = logged_spec(lake, spec)
    wanted = None if days is None else {as_day(d).isoformat() for d in days}
    closed = crowded_days(lake, spec, target_bytes, most_small).where(F.col(EVENT_DATE) < as_day(before).isoformat())
    done = []
    for row in sorted(closed.collect(), key=lambda r: r[EVENT_DATE]):  # one row for each crowded day
        day = row[EVENT_DATE]
        if wanted is not None and day not in wanted:
            continue
        whole = spark.table(table).where(F.col(EVENT_DATE) == day)
        copy = lake.work_dir(f"compact-{spec.name}")
        whole.repartition(max(1, -(-row.bytes // target_bytes))).write.parquet(copy)
        rows = spark.read.schema(whole.schema).parquet(copy)
        if rows.count() != whole.count():
            raise RuntimeError(f"{table} changed on {day} while it was copied; nothing was exchanged")
        files = max(1, -(-row.bytes // target_bytes))
        rows.coalesce(files).select(*whole.columns).write.insertInto(table, overwrite=True)
        now = log_files(spark, table).where(F.col(EVENT_DATE) == day)
        others = merged_files(lake, spec).where(F.col(EVENT_DATE) != day)
        record_files(lake, spec, others.unionByName(now.select(*others.columns)))
        remove_dir(spark, copy)
        done.append(day)
    return done
