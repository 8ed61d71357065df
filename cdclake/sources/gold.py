"""Gold kept up to date in proportion to what changed in silver.

A mart's exact sums lie in a table of their own. The gold table's properties name it and the silver snapshots it was
made from; the next run compares those snapshots with the published ones, adds the difference to the sums and
writes the days of gold that it touches. The names change in one step, after gold was written. A run that ends before
leaves a mark in place, and the next one writes all days from the sums.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.operators.mart_sums import MART_SUMS, MartSums, signed_images
from cdclake.sources.lake import (
    STATE,
    Lake,
    _properties,
    published_snapshot,
    refresh,
    remove_dir,
    scan_snapshot,
)
from cdclake.specs import TableSpec

SUMS = "cdclake.sums"
MADE_FROM = "cdclake.made_from"
UNFINISHED = "cdclake.unfinished"


def forget_sums(lake: Lake, mart: str) -> None:
    """Before gold is written in another way: its sums no longer tell what it holds."""
    if lake.catalog:
        return
    kept = _properties(lake, lake.gold(mart)).get(SUMS)
    if kept:
        lake.spark.sql(f"ALTER TABLE {lake.gold(mart)} UNSET TBLPROPERTIES IF EXISTS ('{SUMS}', '{MADE_FROM}', '{UNFINISHED}')")
        lake.spark.sql(f"DROP TABLE IF EXISTS {lake.table('silver', kept)}")


def refresh_changed(lake: Lake, mart: str, specs: Mapping[str, TableSpec]) -> dict[str, int]:
    """Bring a mart up to date. ``days`` counts the days written; ``whole`` is 1 if it was made from all rows, as the first
    time and where a snapshot it was made from is gone."""
    if lake.catalog:
        raise ValueError("marts follow changes in Parquet lakes only")
    spark, how = lake.spark, MART_SUMS[mart]
    known = _properties(lake, lake.gold(mart))
    now = {name: published_snapshot(lake, specs[name]) for name in how.inputs}
    if None in now.values():
        raise ValueError(f"silver has no table for {sorted(n for n, s in now.items() if s is None)}")
    before = json.loads(known.get(MADE_FROM, "{}"))
    sums = known.get(SUMS)
    unfinished = known.get(UNFINISHED) == "true"
    if before == now and not unfinished and _exists(lake, sums):
        return {"days": 0, "whole": 0}

    frames = _inputs(lake, how, specs, now)
    held = [sums, *before.values()]
    follows = before.keys() == now.keys() and all(_exists(lake, name) for name in held)
    scratch: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        scratch.append(lake.work_dir(f"{mart}-changes"))
        df.write.parquet(scratch[-1])
        return spark.read.schema(df.schema).parquet(scratch[-1])

    try:
        if follows:
            held = spark.table(lake.table("silver", sums))
            delta = keep(_delta(lake, how, specs, before, now, frames, keep, held))
            # One value for each day that changed.
            days = [r[0] for r in delta.select(how.day).distinct().collect()]
            made = how.add(held, delta)
        else:
            days, made = None, how.whole(frames)
        if days == [] and not unfinished:
            fresh = sums
        else:
            fresh = _save(lake, mart, made)
            table = spark.table(lake.table("silver", fresh))
            if days is None:
                forget_sums(lake, mart)
            spark.sql(f"ALTER TABLE {lake.gold(mart)} SET TBLPROPERTIES ('{UNFINISHED}' = 'true')")
            if days is None or unfinished or not lake.gold_by_day or None in days:
                refresh(lake, how.mart(table), mart)
            else:
                _replace_days(lake, how.mart(table), mart, how.day, days)
        named = {SUMS: fresh, MADE_FROM: json.dumps(now, sort_keys=True), UNFINISHED: "false"}
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in named.items())
        spark.sql(f"ALTER TABLE {lake.gold(mart)} SET TBLPROPERTIES ({listed})")
        if sums and sums != fresh:
            spark.sql(f"DROP TABLE IF EXISTS {lake.table('silver', sums)}")
        written = spark.table(lake.table("silver", fresh)).select(how.day).distinct().count() if days is None else len(days)
        return {"days": written, "whole": int(days is None)}
    finally:
        for path in scratch:
            remove_dir(spark, path)


def _exists(lake: Lake, name: str | None) -> bool:
    return bool(name) and lake.spark.catalog.tableExists(lake.table("silver", name))


def _inputs(lake: Lake, how: MartSums, specs: Mapping[str, TableSpec], names: Mapping[str, str]) -> dict[str, DataFrame]:
    return {n: scan_snapshot(lake, specs[n], names[n]).select(specs[n].pk, *_others(specs[n], c)) for n, c in how.inputs.items()}


def _others(spec: TableSpec, columns) -> list[str]:
    return [c for c in columns if c != spec.pk]


def _delta(
    lake: Lake,
    how: MartSums,
    specs: Mapping[str, TableSpec],
    before: Mapping[str, str],
    now: Mapping[str, str],
    frames: Mapping[str, DataFrame],
    keep: Callable[[DataFrame], DataFrame],
    held: DataFrame,
) -> DataFrame:
    old = _inputs(lake, how, specs, before)
    images = {}
    for n, columns in how.inputs.items():
        # A table without a new snapshot has no changed rows.
        left, right = (old[n], frames[n]) if before[n] != now[n] else (old[n].limit(0), frames[n].limit(0))
        images[n] = signed_images(left, right, specs[n].pk, columns)
    return how.delta(images, old, frames, keep, held)


def _save(lake: Lake, mart: str, sums: DataFrame) -> str:
    name = f"{mart}_sums_{uuid.uuid4().hex[:12]}"
    sums.write.format(lake.provider).saveAsTable(lake.table("silver", name))
    lake.spark.sql(f"ALTER TABLE {lake.table('silver', name)} SET TBLPROPERTIES ('{STATE}' = 'true')")
    return name


def _replace_days(lake: Lake, rows: DataFrame, mart: str, day: str, days: list[dt.date]) -> None:
    """Drop the given days of a mart partitioned by day, and write those that still have rows."""
    if not days:
        return
    listed = ", ".join(f"PARTITION ({day} = '{d.isoformat()}')" for d in days)
    lake.spark.sql(f"ALTER TABLE {lake.gold(mart)} DROP IF EXISTS {listed}")
    rows = rows.where(F.col(day).isin(days)).select(*lake.scan(lake.gold(mart)).columns)
    writers = min(len(days), int(lake.spark.conf.get("spark.sql.shuffle.partitions")))
    rows.repartition(writers, day).sortWithinPartitions(day).write.insertInto(lake.gold(mart))
