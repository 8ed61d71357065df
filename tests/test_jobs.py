import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cdclake.plans import jobs
from cdclake.plans.jobs import JobFailed, run_bronze, run_gold, run_silver, snapshot, write_report
from cdclake.sources import lake as lk
from cdclake.sources import ledger
from cdclake.sources.change_files import table_path, write_change_files
from cdclake.specs import entity
from conftest import rows
from util import ITEM, at, changes

PNR, PAY, SEG = entity("pnr_records"), entity("payments"), entity("flight_segments")
SPECS = {s.name: s for s in (PNR, PAY, SEG)}
T0 = at("2024-01-05 10:00:00")


@pytest.fixture
def loaded(spark, lake, tmp_path):
    """One day of files for bookings, payments and segments, none for the day after."""
    root = str(tmp_path / "raw")
    feeds = {
        PNR: [("A", "WEB", "CREATED", T0, T0, "c", 1), ("A", "WEB", "TICKETED", T0, T0, "u", 2)],
        PAY: [("p", "A", "CASH", None, "VND", "SUCCESS", T0, T0, "c", 1)],
        SEG: [(1, "A", "HAN", "SGN", dt.date(2024, 2, 1), "VN", "VN1", T0, T0, "c", 1)],
    }
    for spec, data in feeds.items():
        log = changes(spark, data, spec)
        if spec is PAY:
            log = log.withColumn("amount", F.lit(90.0))
        write_change_files(log, root, spec)
    lk.create_layers(lake, SPECS.values())
    return lake, root


def test_all_jobs(spark, loaded):
    lake, root = loaded
    assert {r.status for r in run_bronze(lake, root, "2024-01-01", specs=SPECS)} == {"ok"}
    assert {r.status for r in run_bronze(lake, root, "2024-01-01", specs=SPECS)} == {"ok"}  # replay
    assert spark.table(lake.bronze(PNR)).count() == 2
    assert [r.item for r in run_silver(lake, specs=SPECS)] == list(SPECS)
    run_silver(lake, "pnr_records", since="2024-01-01", specs=SPECS)
    assert rows(lk.scan_silver(lake, PNR), "pnr_id", "booking_status") == [("A", "TICKETED")]
    run_gold(lake, specs=SPECS)
    revenue = spark.table(lake.gold("revenue_by_route"))
    assert rows(revenue, "origin_airport", F.col("total_revenue").cast("string"), "total_bookings") == [
        ("HAN", "90.00", 1)
    ]
    assert spark.table(lake.gold("payment_status_summary")).count() == 1
    assert spark.table(lake.gold("daily_booking_summary")).count() == 1
    assert rows(spark.table(lake.gold("daily_cancellation_rate")), "cancellation_rate") == [(0.0,)]


def test_missing_day_is_reported_only(loaded):
    lake, root = loaded
    results = run_bronze(lake, root, "2024-01-02", specs=SPECS)
    assert {r.status for r in results} == {"missing"}


def test_one_bad_table_does_not_stop_the_others(spark, loaded):
    lake, root = loaded
    text = spark.createDataFrame([("not a number",)], "amount string")
    text.write.mode("append").parquet(f"{table_path(root, PAY)}/event_date=2024-01-01/__op=c")
    with pytest.raises(JobFailed, match="payments") as failure:
        run_bronze(lake, root, "2024-01-01", specs=SPECS)
    assert {r.item: r.status for r in failure.value.results} == {
        "pnr_records": "ok",
        "payments": "failed",
        "flight_segments": "ok",
    }
    lenient = run_bronze(lake, root, "2024-01-01", specs=SPECS, strict=False)
    assert [r.status for r in lenient].count("failed") == 1


def test_unknown_names_and_dates_are_refused(loaded):
    lake, root = loaded
    with pytest.raises(ValueError, match="unknown"):
        run_silver(lake, "no_such_table", specs=SPECS)
    with pytest.raises(ValueError, match="unknown"):
        run_gold(lake, ["no_such_mart"], specs=SPECS)
    with pytest.raises(ValueError):
        run_bronze(lake, root, "yesterday", specs=SPECS)
    with pytest.raises(ValueError, match="unknown table"):
        entity("no_such_table")


def test_report_accumulates_runs(spark, tmp_path):
    checks = spark.createDataFrame([("silver", "t", "c", 0, "OK", "")], "step string, table_name string, check_name string, value bigint, status string, detail string")
    path = str(tmp_path / "reports")
    for day in (1, 2):
        write_report(checks, path, dt.datetime(2024, 1, day))
    assert spark.read.parquet(path).select("run_ts").distinct().count() == 2


def test_snapshot_is_read_from_files(spark, lake):
    copy = snapshot(lake, spark.range(5).toDF("id"), "ids")
    assert copy.count() == 5 and copy.inputFiles()


def test_reconciliation_of_a_loaded_lake(spark, loaded):
    lake, root = loaded
    run_bronze(lake, root, "2024-01-01", specs=SPECS)
    run_silver(lake, specs=SPECS)
    source = {name: lk.scan_silver(lake, spec) for name, spec in SPECS.items()}
    source["payments"] = source["payments"].withColumn("payment_status", F.lit("FAILED"))
    pairs = jobs.load_pairs(lake, lambda spec: source[spec.name], SPECS)
    assert pairs["payments"][0].inputFiles()
    checks = jobs.run_reconciliation(pairs, ["silver", "state"], specs=SPECS)
    assert rows(checks.where("status <> 'OK'"), "table_name", "check_name", "value") == [
        ("payments", "payment_status_mismatch", 1)
    ]
    assert spark.sql("SELECT * FROM src_pnr_records JOIN slv_pnr_records USING (pnr_id)").count() == 1


def test_gold_jobs_cover_the_marts():
    from cdclake.specs import MARTS

    assert list(jobs.MART_JOBS) == list(MARTS)


def test_shuffle_width_follows_the_data():
    from cdclake.plans.session import settings

    def width(n):
        return int(settings(n, cores=16)["spark.sql.shuffle.partitions"])

    assert [width(n) for n in (0, 192 * 1024**2 * 100, 10**15)] == [16, 100, 4_967_054]
    assert settings(10**15, 16, max_partitions=40_000)["spark.sql.shuffle.partitions"] == "40000"


def test_a_wrong_root_is_a_failure(loaded):
    lake, root = loaded
    with pytest.raises(FileNotFoundError, match="typo"):
        run_bronze(lake, root + "/typo", "2024-01-01", specs=SPECS)


def test_errors_are_kept_whole(spark, loaded):
    lake, root = loaded
    text = spark.createDataFrame([("not a number",)], "amount string")
    text.write.mode("append").parquet(f"{table_path(root, PAY)}/event_date=2024-01-01/__op=c")
    with pytest.raises(JobFailed) as failure:
        run_bronze(lake, root, "2024-01-01", specs=SPECS)
    bad = next(r for r in failure.value.results if r.status == "failed")
    assert bad.error is failure.value.__cause__ and bad.detail == str(bad.error)


def test_bad_rows_are_set_aside_and_counted(spark, loaded):
    lake, root = loaded
    huge = spark.read.parquet(table_path(root, PAY)).limit(1).drop("event_date", "__op").withColumn("amount", F.lit(1e15))
    huge.write.mode("append").parquet(f"{table_path(root, PAY)}/event_date=2024-01-01/__op=c")
    for _ in range(2):  # loading again doesn't double what was set aside
        results = {r.item: r for r in run_bronze(lake, root, "2024-01-01", specs=SPECS, quarantine=True)}
        assert results["payments"].counts == {"rejected": 1}
        assert spark.table(jobs.rejected_table(lake, PAY)).count() == 1
    assert spark.table(lake.bronze(PAY)).count() == 1


def test_silver_reads_each_day_once(spark, loaded):
    lake, root = loaded
    run_bronze(lake, root, "2024-01-01", specs=SPECS)
    first = {r.item: r.counts for r in run_silver(lake, specs=SPECS)}
    assert {c["days"] for c in first.values()} == {1}
    assert {r.counts["days"] for r in run_silver(lake, specs=SPECS)} == {0}
    late = spark.table(lake.bronze(PNR)).limit(1).withColumn("event_date", F.lit("2024-01-02")).withColumn("__op", F.lit(None).cast("string"))
    lk.append_bronze(lake, late, PNR)
    second = {r.item: r.counts for r in run_silver(lake, specs=SPECS)}
    assert second["pnr_records"] == {"null_keys": 0, "null_ops": 1, "days": 1}
    assert second["payments"] == {"days": 0}
    run_bronze(lake, root, "2024-01-01", specs=SPECS)  # loaded again, so merged again
    assert {r.counts["days"] for r in run_silver(lake, specs=SPECS)} == {1}


def test_directories_named_by_topic(spark, lake, loaded, tmp_path):
    lake, root = loaded
    layout = "bookings.public.{table}"
    again = str(tmp_path / "topics")
    for spec in SPECS.values():
        write_change_files(spark.read.parquet(table_path(root, spec)).withColumn("event_date", F.col("event_date").cast("string")), again, spec, layout=layout)
    assert {r.status for r in run_bronze(lake, again, "2024-01-01", specs=SPECS, layout=layout)} == {"ok"}
    assert spark.table(lake.bronze(PNR)).count() == 2


def test_offenders_and_no_leftovers(spark, loaded):
    import os

    lake, root = loaded
    run_bronze(lake, root, "2024-01-01", specs=SPECS)
    run_silver(lake, specs=SPECS)
    source = {name: lk.scan_silver(lake, spec) for name, spec in SPECS.items()}
    source["payments"] = source["payments"].withColumn("payment_status", F.lit("FAILED"))
    pairs = jobs.load_pairs(lake, lambda spec: source[spec.name], SPECS)
    found = jobs.reconciliation_offenders(pairs, SPECS).collect()
    assert [(r.table_name, r.check_name) for r in found] == [("payments", "payment_status_mismatch")]
    jobs.drop_snapshots(lake, pairs)
    assert os.listdir(f"{lake.root}/_work") == []


def test_sequence_decides_within_a_millisecond(spark, lake):
    from dataclasses import replace

    spec = replace(ITEM, seq_column="seq")
    lk.create_layers(lake, [spec])
    base = changes(spark, [(1, "a", 1, "c", 5), (1, "a", 1, "d", 5), (1, "again", 2, "c", 5)])
    log = base.withColumn("seq", F.when(F.col("name") == "again", 3).when(F.col("__op") == "d", 2).otherwise(1).cast("long"))
    for part in (log.where("seq = 3"), log.where("seq < 3")):
        lk.append_bronze(lake, part, spec)
        run_silver(lake, specs={"items": spec})
    assert rows(lk.scan_silver(lake, spec)) == [(1, "again", 2)]


def test_a_reload_without_good_rows_empties_the_day(spark, loaded):
    lake, root = loaded
    run_bronze(lake, root, "2024-01-01", specs=SPECS)
    lk.append_bronze(lake, spark.table(lake.bronze(PAY)).withColumn("event_date", F.lit("2024-01-02")), PAY)
    good = spark.read.parquet(table_path(root, PAY)).drop("event_date", "__op")

    def reload(rows, **options):
        again = f"{root}-{len(os.listdir(os.path.dirname(root)))}"
        for spec in SPECS.values():
            target = f"{table_path(again, spec)}/event_date=2024-01-01/__op=c"
            (rows if spec is PAY else spark.read.parquet(table_path(root, spec)).drop("event_date", "__op")).write.parquet(target)
        results = {r.item: r for r in run_bronze(lake, again, "2024-01-01", specs=SPECS, **options)}
        return results["payments"], rows_by_day()

    def rows_by_day():
        return rows(spark.table(lake.bronze(PAY)).groupBy("event_date").count())

    import os

    assert rows_by_day() == [("2024-01-01", 1), ("2024-01-02", 1)]
    assert reload(good.limit(0))[1] == [("2024-01-02", 1)]
    run_bronze(lake, root, "2024-01-01", specs=SPECS)
    result, left = reload(good.withColumn("amount", F.lit(1e15)), quarantine=True)
    assert result.counts == {"rejected": 1} and left == [("2024-01-02", 1)]
    assert spark.table(jobs.rejected_table(lake, PAY)).count() == 1
    result, left = reload(good, quarantine=True)
    assert result.counts == {"rejected": 0} and left == [("2024-01-01", 1), ("2024-01-02", 1)]
    assert spark.table(jobs.rejected_table(lake, PAY)).count() == 0


def test_only_added_files_are_read(spark, lake):
    lk.create_layers(lake, [ITEM])
    lk.append_bronze(lake, changes(spark, [(i, "a", 1, "c", 1) for i in range(20)]).repartition(4), ITEM)
    run_silver(lake, specs={"items": ITEM})
    lk.append_bronze(lake, changes(spark, [(3, "b", 1, "u", 2)]).coalesce(1), ITEM)
    name = lake.bronze(ITEM)
    listed = ledger.log_files(spark, name)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in plan and "Parquet" not in plan and "content" not in plan.split("ReadSchema")[1]
    fresh = ledger.unmerged(listed, lk.merged_files(lake, ITEM))
    changed, days = ledger.read_files(spark, name, fresh)
    assert days == 1 and len(changed.inputFiles()) == 1 and rows(changed, "id", "name", "event_date") == [(3, "b", "2024-01-01")]
    by_day, _ = ledger.read_files(spark, name, fresh, by_name=0)
    assert by_day.count() == 21  # too many files to name: their whole days, which merges to the same
    assert run_silver(lake, specs={"items": ITEM})[0].counts["days"] == 1
    assert run_silver(lake, specs={"items": ITEM})[0].counts == {"days": 0}
    assert rows(lk.scan_silver(lake, ITEM).where("id = 3")) == [(3, "b", 1)]


def test_merged_files_follow_since_and_versions(spark, lake):
    lk.create_layers(lake, [ITEM])
    log = changes(spark, [(1, "a", 1, "c", 1)])
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        lk.append_bronze(lake, log.withColumn("event_date", F.lit(day)), ITEM)
    assert run_silver(lake, since="2024-01-02", specs={"items": ITEM})[0].counts["days"] == 2
    assert rows(lk.merged_files(lake, ITEM), "event_date") == [("2024-01-02",), ("2024-01-03",)]
    assert run_silver(lake, specs={"items": ITEM})[0].counts["days"] == 1
    for _ in range(4):
        lk.apply_changes(lake, log, ITEM)
    assert lk.merged_files(lake, ITEM).count() == 3  # kept while other writers publish
    lk.append_bronze(lake, log.withColumn("event_date", F.lit("2024-01-02")), ITEM, idempotent=True)
    assert run_silver(lake, since="2024-01-03", specs={"items": ITEM})[0].counts["days"] == 1
    assert run_silver(lake, specs={"items": ITEM})[0].counts["days"] == 1
    kept = [r.tableName for r in spark.sql(f"SHOW TABLES IN {lake.namespace('silver')}").collect()]
    assert sum("_files_v" in t for t in kept) == lake.keep_versions
    assert ("silver", "items_clean") in rows(lk.list_tables(lake)) and not any("_files_v" in r[1] for r in rows(lk.list_tables(lake)))


def test_new_columns(spark, lake, tmp_path):
    root = str(tmp_path / "raw")
    lk.create_layers(lake, [ITEM])
    specs = {"items": ITEM}
    log = changes(spark, [(1, "a", 1, "c", 1), (2, "b", 2, "c", 1)])
    write_change_files(log, root, ITEM)
    later = changes(spark, [(2, "bb", 2, "u", 2), (3, "c", 3, "c", 2)]).withColumns(
        {"event_date": F.lit("2024-01-02"), "colour": F.lit("red"), "price": F.lit(1.5).cast("decimal(9,2)"), "__extra": F.lit(1)}
    )
    write_change_files(later, root, ITEM)
    run_bronze(lake, root, "2024-01-01", specs=specs)
    run_silver(lake, specs=specs)
    (result,) = run_bronze(lake, root, "2024-01-02", specs=specs)
    assert result.left_out == ("colour", "price") and "colour" not in spark.table(lake.bronze(ITEM)).columns
    with pytest.raises(JobFailed, match="colour is new"):
        run_bronze(lake, root, "2024-01-02", specs=specs, new_columns="refuse")
    with pytest.raises(ValueError, match="new_columns"):
        run_bronze(lake, root, "2024-01-02", specs=specs, new_columns="whatever")
    (result,) = run_bronze(lake, root, "2024-01-02", specs=specs, new_columns="widen")
    assert result.left_out == ()
    wide = lk.logged_spec(lake, ITEM)
    assert wide.columns == ["id", "name", "qty", "colour", "price"]
    assert lk.scan_silver(lake, wide).where("colour IS NULL").count() == 2  # before the next merge
    run_silver(lake, specs=specs)
    got = rows(lk.scan_silver(lake, wide).withColumn("price", F.col("price").cast("string")))
    assert got == [(1, "a", 1, None, None), (2, "bb", 2, "red", "1.50"), (3, "c", 3, "red", "1.50")]
    assert rows(lk.scan_silver(lake, ITEM), "id") == [(1,), (2,), (3,)]
    # Files of before, and appends without the column, still fit.
    run_bronze(lake, root, "2024-01-01", specs=specs)
    lk.append_bronze(lake, changes(spark, [(4, "d", 4, "c", 3)]), ITEM)
    run_silver(lake, specs=specs)
    assert rows(lk.scan_silver(lake, wide), "id", "colour") == [(1, None), (2, "red"), (3, "red"), (4, None)]
    heavy = changes(spark, []).withColumn("weight", F.lit(1))
    assert lk.append_bronze(lake, heavy, ITEM) == ("weight",)
    assert lk.append_bronze(lake, heavy, ITEM, new_columns="widen") == ()
    assert lk.logged_spec(lake, ITEM).columns[-1] == "weight"


def test_incompatible_files_are_refused(spark, lake, tmp_path):
    root = str(tmp_path / "raw")
    lk.create_layers(lake, [ITEM])
    log = changes(spark, [(1, "a", 1, "c", 1)]).drop("event_date", "__op")
    for day, rows_ in (
        ("2024-01-01", log.withColumn("qty", F.lit("many"))),
        ("2024-01-02", log.drop("id")),
        ("2024-01-03", log.withColumn("id", F.col("id").cast("int"))),
    ):
        rows_.write.parquet(f"{table_path(root, ITEM)}/event_date={day}/__op=c")
    with pytest.raises(JobFailed, match="qty is string, not int"):
        run_bronze(lake, root, "2024-01-01", specs={"items": ITEM})
    with pytest.raises(JobFailed, match="key id is missing"):
        run_bronze(lake, root, "2024-01-02", specs={"items": ITEM})
    assert spark.table(lake.bronze(ITEM)).count() == 0
    run_bronze(lake, root, "2024-01-03", specs={"items": ITEM})  # narrower than the log's type
    assert rows(spark.table(lake.bronze(ITEM)), "id") == [(1,)]
