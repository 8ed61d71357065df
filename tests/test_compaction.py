import pytest
from pyspark.sql import functions as F

from cdclake.operators.sketches import distinct_in_range, distinct_sketches, merge_sketches, relative_error
from cdclake.plans.jobs import run_silver
from cdclake.sources import compaction, ledger
from cdclake.sources import lake as lk
from cdclake.sources.compaction import compact, crowded_days
from conftest import rows
from util import ITEM, changes

SPECS = {"items": ITEM}


def add(spark, lake, day, ids, files):
    log = changes(spark, [(i, f"n{i}", i, "c", 1) for i in ids]).withColumn("event_date", F.lit(day))
    lk.append_bronze(lake, log.repartition(files), ITEM)


def files_by_day(spark, lake):
    return dict(rows(ledger.log_files(spark, lake.bronze(ITEM)).groupBy("event_date").count()))


@pytest.fixture
def crowded(spark, lake):
    lk.create_layers(lake, [ITEM])
    add(spark, lake, "2024-01-01", range(40), 20)
    add(spark, lake, "2024-01-02", range(40, 60), 10)
    add(spark, lake, "2024-01-03", range(60, 70), 2)
    run_silver(lake, specs=SPECS)
    return lake


def test_small_files_of_closed_days_become_few(spark, crowded):
    lake, before = crowded, rows(spark.table(crowded.bronze(ITEM)))
    many = files_by_day(spark, lake)
    assert many["2024-01-01"] > 10 and many["2024-01-02"] > 4
    version, snapshot = lk._version(lake, ITEM), lk.read_state(lake, ITEM).inputFiles()
    assert compact(lake, ITEM, before="2024-01-02") == ["2024-01-01"]
    assert files_by_day(spark, lake) == many | {"2024-01-01": 1}
    assert compact(lake, ITEM, before="2024-02-01") == ["2024-01-02"]
    assert compact(lake, ITEM, before="2024-02-01") == []
    assert rows(spark.table(lake.bronze(ITEM))) == before
    assert (lk._version(lake, ITEM), lk.read_state(lake, ITEM).inputFiles()) == (version, snapshot)
    assert run_silver(lake, specs=SPECS)[0].counts == {"days": 0}
    assert rows(lk.scan_silver(lake, ITEM).agg(F.count("*"))) == [(70,)]


def test_days_with_files_not_merged_are_left(spark, crowded):
    add(spark, crowded, "2024-01-01", [999], 1)
    assert rows(crowded_days(crowded, ITEM), "event_date") == [("2024-01-02",)]
    assert compact(crowded, ITEM, before="2024-02-01", days=["2024-01-01"]) == []
    assert run_silver(crowded, specs=SPECS)[0].counts["days"] == 1
    assert compact(crowded, ITEM, before="2024-02-01", days=["2024-01-01"]) == ["2024-01-01"]
    assert run_silver(crowded, specs=SPECS)[0].counts == {"days": 0}


def test_a_failure_between_exchange_and_record_costs_a_merge_only(spark, crowded, monkeypatch):
    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(compaction, "record_files", lost)
    with pytest.raises(RuntimeError, match="lost"):
        compact(crowded, ITEM, before="2024-01-02")
    state = rows(lk.read_state(crowded, ITEM))
    assert run_silver(crowded, specs=SPECS)[0].counts["days"] == 1
    assert rows(lk.read_state(crowded, ITEM)) == state and spark.table(crowded.bronze(ITEM)).count() == 70


def test_sketches_add_up(spark):
    df = spark.range(30_000).select((F.col("id") % 9000).alias("k"), F.to_date(F.lit("2024-01-01")).alias("d"), (F.col("id") % 2).alias("g"))
    df = df.withColumn("d", F.date_add("d", (F.col("k") % 10).cast("int")))
    parts = [distinct_sketches(df.where(F.col("k") % 3 == i), "k", "d", "g") for i in range(3)]
    stored = merge_sketches(merge_sketches(parts[0], parts[1], "d", "g"), parts[2], "d", "g")
    twice = merge_sketches(stored, parts[1], "d", "g")
    for sketches in (stored, twice):
        got = dict(rows(distinct_in_range(sketches, "d", "2024-01-02", "2024-01-06", "g")))
        exact = dict(rows(df.where("d BETWEEN '2024-01-02' AND '2024-01-06'").groupBy("g").agg(F.count_distinct("k"))))
        assert got.keys() == exact.keys()
        assert all(abs(got[g] - exact[g]) <= relative_error() * exact[g] for g in exact)
    assert rows(distinct_in_range(stored, "d", "2030-01-01", "2030-01-02", "g")) == []
