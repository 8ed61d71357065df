from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cdclake.operators.merge import as_state, merge_state
from cdclake.sources import lake as lk
from cdclake.sources.change_files import read_changes, write_change_files
from cdclake.specs import ENTITIES, MARTS, entity
from conftest import rows
from util import ITEM, at, changes, table


def on(df, day):
    return df.withColumn("event_date", F.lit(day))


def test_layers_have_the_declared_tables(spark, lake):
    lk.create_layers(lake)
    lk.create_layers(lake)  # again: nothing to do
    assert {lake.namespace(x) for x in lk.LAYERS} <= {r[0] for r in rows(lk.list_namespaces(lake))}
    listed = rows(lk.list_tables(lake))
    assert listed == sorted(
        [("bronze", n) for n in ENTITIES]
        + [("silver", s.silver_name) for s in ENTITIES.values()]
        + [("gold", m) for m in MARTS]
    )
    payments = entity("payments")
    bronze = spark.table(lake.bronze(payments)).schema
    assert bronze.simpleString() == payments.change_schema.simpleString()
    silver = spark.table(lake.silver(payments))
    assert silver.columns == [*payments.columns, "created_at_month"]
    lk.reset(lake)
    assert {r[0] for r in rows(lk.list_tables(lake))} == {"gold"}
    lk.reset(lake, ["gold"], namespaces=True)
    assert not spark.catalog.databaseExists(lake.namespace("gold"))


def test_plain_append_doubles_and_day_replacement_does_not(spark, lake):
    lk.create_bronze(lake, [ITEM])
    log = changes(spark, [(1, "a", 1, "c", 1), (2, "b", 1, "c", 1)])
    first, second = on(log, "2024-01-01"), on(log, "2024-01-02").select(*reversed(log.columns))
    for day in (first, second, second):
        lk.append_bronze(lake, day, ITEM, idempotent=True)
    by_day = spark.table(lake.bronze(ITEM)).groupBy("event_date").count()
    assert rows(by_day) == [("2024-01-01", 2), ("2024-01-02", 2)]
    lk.append_bronze(lake, second, ITEM)
    assert spark.table(lake.bronze(ITEM)).count() == 6


def test_day_replacement_refuses_a_table_that_would_lose_other_days(spark, lake):
    spark.sql(
        f"CREATE TABLE {lake.bronze(ITEM)} (id BIGINT, event_date STRING) USING parquet "
        "PARTITIONED BY (event_date)"
    )
    with pytest.raises(ValueError, match="partitionOverwriteMode"):
        lk.append_bronze(lake, changes(spark, [(1, "a", 1, "c", 1)]), ITEM, idempotent=True)


def test_change_files_round_trip_one_day(spark, tmp_path):
    spec = entity("payments")
    row = ("p", "A", "CASH", None, "VND", "SUCCESS", None, None)
    log = changes(spark, [(*row, "c", 1), (*row, "d", 2)], spec)
    log = log.withColumn("amount", F.lit(12.345))
    for day in ("2024-01-01", "2024-01-02"):
        write_change_files(on(log, day), str(tmp_path), spec)
    got = read_changes(spark, str(tmp_path), spec, "2024-01-02")
    assert got.schema.simpleString() == spec.change_schema.simpleString()
    assert rows(got, "__op", "event_date", F.col("amount").cast("string")) == [
        ("c", "2024-01-02", "12.35"),
        ("d", "2024-01-02", "12.35"),
    ]
    both = read_changes(spark, str(tmp_path), spec, ["2024-01-01", "2024-01-02"])
    assert both.count() == 4 == read_changes(spark, str(tmp_path), spec).count()
    assert (tmp_path / "payments" / "event_date=2024-01-01" / "__op=c").is_dir()


def test_newer_files_with_an_extra_column(spark, tmp_path):
    log = changes(spark, [(1, "a", 1, "c", 1)])
    write_change_files(log, str(tmp_path), ITEM)
    write_change_files(on(log, "2024-01-02").withColumn("colour", F.lit("red")), str(tmp_path), ITEM)
    plain = read_changes(spark, str(tmp_path), ITEM)
    assert plain.columns == ITEM.change_schema.fieldNames() and plain.count() == 2
    merged = read_changes(spark, str(tmp_path), ITEM, merge_schema=True)
    assert rows(merged, "event_date", "colour") == [("2024-01-01", None), ("2024-01-02", "red")]


def test_older_files_without_a_column(spark, tmp_path):
    old = changes(spark, [(1, "a", 1, "c", 1)]).drop("qty", "event_date", "__op")
    old.write.parquet(str(tmp_path / "items" / "event_date=2024-01-01" / "__op=c"))
    assert rows(read_changes(spark, str(tmp_path), ITEM, "2024-01-01"), "id", "qty") == [(1, None)]


@pytest.mark.parametrize("by_day", [False, True])
def test_refresh_replaces_everything(spark, lake, by_day):
    lake = lk.Lake(spark, lake.root, lake.prefix, state_buckets=4, gold_by_day=by_day)
    lk.create_gold(lake)

    def mart(*days):
        return spark.createDataFrame([(d, "WEB", 1) for d in days], "d string, c string, n bigint").select(
            F.to_date("d").alias("booking_date"),
            F.col("c").alias("booking_channel"),
            F.col("n").alias("total_bookings"),
        )

    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        lk.refresh(lake, mart("2024-01-01", "2024-01-02"), "daily_booking_summary")
        lk.refresh(lake, mart("2024-01-02", "2024-01-03"), "daily_booking_summary")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    got = spark.table(lake.gold("daily_booking_summary"))
    assert rows(got, F.col("booking_date").cast("string")) == [("2024-01-02",), ("2024-01-03",)]


def test_silver_snapshots(spark, lake):
    lk.create_silver(lake, [ITEM])
    assert lk.scan_silver(lake, ITEM).count() == 0
    for ts in range(1, 5):
        op = "d" if ts == 4 else "u"
        lk.apply_changes(lake, changes(spark, [(1, f"v{ts}", ts, op, ts), (ts, "x", 0, "c", 0)]), ITEM)
    assert rows(lk.scan_silver(lake, ITEM)) == [(2, "x", 0), (3, "x", 0), (4, "x", 0)]
    assert (1, "d") in rows(lk.read_state(lake, ITEM), "id", "__op")
    kept = [r.tableName for r in spark.sql(f"SHOW TABLES IN {lake.namespace('silver')}").collect()]
    assert sum("_state_v" in t for t in kept) == lake.keep_versions


def test_failed_publication_leaves_readers_where_they_were(spark, lake):
    lk.create_silver(lake, [ITEM])
    lk.apply_changes(lake, changes(spark, [(1, "good", 1, "c", 1)]), ITEM)
    broken = changes(spark, [(2, "bad", 1, "c", 1)]).withColumn(
        "qty", F.raise_error(F.lit("boom")).cast("int")
    )
    with pytest.raises(Exception, match="boom"):
        lk.apply_changes(lake, broken, ITEM)
    assert rows(lk.scan_silver(lake, ITEM)) == [(1, "good", 1)]
    lk.apply_changes(lake, changes(spark, [(2, "fixed", 1, "c", 1)]), ITEM)
    assert rows(lk.scan_silver(lake, ITEM)) == [(1, "good", 1), (2, "fixed", 1)]


@pytest.mark.parametrize("width", ["4", "16"])
def test_merge_does_not_shuffle_the_bucketed_state(spark, lake, width):
    lk.create_silver(lake, [ITEM])
    lk.apply_changes(lake, changes(spark, [(i, "a", 1, "c", 1) for i in range(50)]), ITEM)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        log = changes(spark, [(1, "b", 1, "u", 2)])
        merged = merge_state(lk.read_state(lake, ITEM), log, ITEM, buckets=lake.state_buckets)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        assert "Exchange" not in plan.split("FullOuter", 1)[1].split("FileScan", 1)[0]
        lk.apply_changes(lake, log, ITEM)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows(lk.scan_silver(lake, ITEM).where("name = 'b'"), "id") == [(1,)]
    assert len(lk.read_state(lake, ITEM).inputFiles()) <= lake.state_buckets


def test_month_partitions_prune(spark, lake):
    spec = entity("booking_events")
    lk.create_silver(lake, [spec])
    log = changes(
        spark,
        [(i, "A", "CREATED", at(f"2024-0{i}-15 12:00:00"), "c", 1) for i in (1, 2, 3)]
        + [(9, "A", "CREATED", None, "c", 1)],
        spec,
    )
    lk.apply_changes(lake, log, spec)
    some = lk.scan_silver(lake, spec, "2024-02-01", "2024-03-15")
    assert rows(some, "event_id") == [(2,), (3,)]
    assert "PartitionFilters: [isnotnull(created_at_month" in some._jdf.queryExecution().executedPlan().toString()
    assert lk.scan_silver(lake, spec).count() == 4


def test_views_for_sql(spark):
    df = table(spark, [(1, "a", 1)])
    src, slv = lk.register_pair(ITEM, df, df.limit(0), "x")
    assert (src, slv) == ("src_x", "slv_x")
    assert spark.sql(f"SELECT * FROM {src} LEFT ANTI JOIN {slv} USING (id)").count() == 1


def test_shared_dir_follows_the_session(spark):
    assert lk.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert lk.fresh_dir(spark, "x") != lk.fresh_dir(spark, "x")


def test_cluster_for_write_puts_a_partition_value_in_one_file(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=8).select("id", (F.col("id") % 5).alias("p"))
    lk.cluster_for_write(df, "p", "id").write.partitionBy("p").parquet(str(tmp_path / "c"))
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in (tmp_path / "c").glob("p=*"))


def test_state_projection(spark):
    assert as_state(changes(spark, []), ITEM).columns == ["id", "name", "qty", "__op", "__source_ts_ms"]


def test_a_second_batch_of_a_day_stays(spark, lake):
    lk.create_bronze(lake, [ITEM])
    for i in (1, 2):
        lk.append_bronze(lake, changes(spark, [(i, "a", 1, "c", i)]), ITEM)
    assert rows(spark.table(lake.bronze(ITEM)), "id") == [(1,), (2,)]


def test_appending_needs_no_shuffle(spark, lake):
    lk.create_bronze(lake, [ITEM])
    log = changes(spark, [(i, "a", 1, "c", i) for i in range(20)]).repartition(5)
    lk.append_bronze(lake, log, ITEM)
    seen = spark.table(lake.bronze(ITEM)).inputFiles()
    assert len(seen) == 5  # written where it was, not gathered by day


def test_one_bound_filters_and_a_table_without_day_refuses(spark, lake):
    spec = entity("booking_events")
    lk.create_silver(lake, [spec, ITEM])
    log = changes(spark, [(i, "A", "CREATED", at(f"2024-0{i}-15 12:00:00"), "c", 1) for i in (1, 2, 3)], spec)
    lk.apply_changes(lake, log, spec)
    assert rows(lk.scan_silver(lake, spec, first="2024-02-01"), "event_id") == [(2,), (3,)]
    assert rows(lk.scan_silver(lake, spec, last="2024-02-15"), "event_id") == [(1,), (2,)]
    with pytest.raises(ValueError, match="no day column"):
        lk.scan_silver(lake, ITEM, first="2024-02-01")


def test_a_table_named_like_a_state_is_listed(spark, lake):
    spec = replace(ITEM, name="flight_state")
    lk.create_bronze(lake, [spec])
    lk.create_silver(lake, [spec])
    listed = rows(lk.list_tables(lake, ["bronze", "silver"]), "layer", "table_name")
    assert listed == [("bronze", "flight_state"), ("silver", "flight_state_clean")]


def test_settings_that_lose_data_are_refused(spark, lake):
    with pytest.raises(ValueError, match="keep_versions"):
        replace(lake, keep_versions=0)
    with pytest.raises(ValueError, match="state_buckets"):
        replace(lake, state_buckets=None)


def test_two_writers_do_not_undo_each_other(spark, lake):
    lk.create_silver(lake, [ITEM])
    base = lk._version(lake, ITEM)
    mine = lk.read_state(lake, ITEM)
    lk.apply_changes(lake, changes(spark, [(1, "theirs", 1, "c", 1)]), ITEM)
    with pytest.raises(lk.ConcurrentWrite):
        lk.publish_state(lake, ITEM, mine, base=base)
    assert rows(lk.scan_silver(lake, ITEM)) == [(1, "theirs", 1)]


def test_without_a_shared_folder_there_is_an_error(spark, monkeypatch):
    context = type("Context", (), {"getCheckpointDir": lambda self: None})()
    conf = type("Conf", (), {"get": lambda self, key, default: default})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lk.shared_dir(type("Session", (), {"conf": conf, "sparkContext": context})())
