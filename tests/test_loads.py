"""How the suite's lakes are loaded: buckets by the size of the input, changes moved once a merge."""

import datetime as dt
import os

from cdclake.operators.merge import merge_state
from cdclake.sources.change_files import read_changes, table_path, write_change_files
from cdclake.sources.lake import apply_changes, create_layers, read_state, scan_silver
from conftest import rows
from suite import bindings as b
from suite import lakes
from util import ITEM, changes


def test_buckets_follow_the_input(spark, tmp_path):
    for name in lakes.FEED_TABLES:
        (tmp_path / f"{name}.parquet").write_bytes(b"")
    assert lakes.state_buckets(spark, str(tmp_path)) == 8
    with open(tmp_path / "lineitem.parquet", "wb") as f:
        f.truncate(20 * lakes.BUCKET_BYTES + 1)  # sparse, takes no room
    assert lakes.state_buckets(spark, str(tmp_path)) == 21


def test_a_table_in_many_files_counts_whole(spark, tmp_path):
    for name in lakes.FEED_TABLES:
        os.makedirs(tmp_path / f"{name}.parquet")
    for part in range(3):
        with open(tmp_path / "orders.parquet" / f"part-{part}", "wb") as f:
            f.truncate(4 * lakes.BUCKET_BYTES)
    assert lakes.state_buckets(spark, str(tmp_path)) == 12


def test_settings_of_a_load_end_with_it(spark):
    names = ("spark.sql.shuffle.partitions", "spark.sql.parquet.compression.codec")
    before = [spark.conf.get(n) for n in names]
    try:
        with lakes.sized_for(spark, 21):
            assert [spark.conf.get(n) for n in names] == ["21", "zstd"]
            raise ValueError
    except ValueError:
        pass
    assert [spark.conf.get(n) for n in names] == before


def test_a_merge_moves_its_changes_once(spark, lake):
    create_layers(lake, [ITEM])
    log = changes(spark, [(i, f"n{i}", i, "c", i) for i in range(50)])
    with lakes.sized_for(spark, lake.state_buckets):
        merged = merge_state(read_state(lake, ITEM), log, ITEM, buckets=lake.state_buckets)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert merged.count() == 50


def test_small_files_of_a_state_share_a_task(spark, lake):
    """There is one for every month and bucket; with a task for every few, shuffles get blocks of a few rows."""
    spec = b.SPECS["payments"]
    create_layers(lake, [spec])
    days = [dt.datetime(1990 + i // 12, 1 + i % 12, 1) for i in range(120)]
    log = [(str(i), "1", "CASH", None, "VND", "SUCCESS", day, day, "c", 1) for i, day in enumerate(days)]
    apply_changes(lake, changes(spark, log, spec), spec)
    with lakes.sized_for(spark, lake.state_buckets):
        statuses = scan_silver(lake, spec).select("payment_status")
        assert len(statuses.inputFiles()) == 120
        assert statuses.rdd.getNumPartitions() <= 16
        assert statuses.count() == 120


def test_change_files_without_a_shuffle(spark, tmp_path):
    """As many writers as tasks, though the rows would fit one file; the same rows."""
    log = changes(spark, [(i, f"n{i}", i, "c", i) for i in range(60)]).repartition(3)
    write_change_files(log, str(tmp_path), ITEM, rebalance=False)
    written = table_path(str(tmp_path), ITEM)
    files = [f for _, _, found in os.walk(written) for f in found if f.endswith(".parquet")]
    assert len(files) == 3
    kept = read_changes(spark, str(tmp_path), ITEM)
    assert rows(kept, "id", "name", "qty", "__op") == rows(log, "id", "name", "qty", "__op")


def test_tasks_of_a_capture_take_in_little(spark, tmp_path):
    """A large file is read by several tasks, so that each sorts its parsed messages in memory."""
    with open(tmp_path / "text", "wb") as f:
        f.write((b"x" * 999 + b"\n") * 40_000)
    whole = spark.read.text(str(tmp_path / "text")).rdd.getNumPartitions()
    with lakes.small_tasks(spark):
        small = spark.read.text(str(tmp_path / "text")).rdd.getNumPartitions()
    assert small >= 3 and small >= whole
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != lakes.TASK_BYTES


def small_tables(spark, path):
    """Order 1 has lines of both states, order 2 none, order 3 occurs twice; no supplier, no customer is missing."""
    day = dt.datetime(1995, 3, 1)
    tables = {
        "nation": ("n_nationkey int, n_name string", [(7, "PERU"), (8, "CHINA")]),
        "supplier": ("s_suppkey long, s_nationkey int", [(1, 7)]),
        "customer": ("c_custkey long, c_nationkey int", [(5, 8)]),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
            [(k, 5, "O", 10.0 * k, day, "HIGH") for k in (1, 2, 3, 3)],
        ),
        "lineitem": (
            "l_orderkey long, l_linenumber int, l_suppkey long, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
            [(1, 1, 1, "R", "F", day), (1, 2, 1, "N", "O", day), (3, 1, 1, None, "F", day)],
        ),
    }
    for name, (schema, data) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_the_feed_reads_lines_once_for_both_days(spark, tmp_path):
    sf = small_tables(spark, tmp_path)
    for name in ("pnr_records", "payments", "flight_segments"):
        plan = b.feed(spark, sf, name)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [l_orderkey") == 1
    status = lambda name, key, column: rows(b.feed(spark, sf, name), "event_date", "__op", key, column)
    one, two = b.DAY_1, b.DAY_2
    assert status("pnr_records", "pnr_id", "booking_status") == sorted(
        [(one, "r", k, "CREATED") for k in "1233"]
        + [(two, "u", "1", "CANCELLED"), (two, "d", "2", None), (two, "u", "3", "TICKETED"), (two, "u", "3", "TICKETED")],
        key=repr,
    )
    assert status("payments", "payment_id", "payment_status") == sorted(
        [(one, "r", k, "PENDING") for k in "1233"] + [(two, "u", "1", "FAILED")] + 2 * [(two, "u", "3", "SUCCESS")], key=repr
    )
    # Line 25 belongs to the order that occurs twice.
    assert status("flight_segments", "segment_id", "dest_airport") == sorted(
        [(one, "r", k, "CHINA") for k in (9, 10, 25, 25)] + [(two, "d", 9, "CHINA")], key=repr
    )


def test_marts_are_made_with_the_settings_of_the_load(spark, tmp_path, monkeypatch):
    """Their shuffles too are as wide as the input is large."""
    seen = []
    for job in ("run_bronze", "run_silver", "run_gold"):
        monkeypatch.setattr(
            lakes, job, lambda *a, job=job, **k: seen.append((job, spark.conf.get("spark.sql.shuffle.partitions")))
        )
    monkeypatch.setattr(lakes, "feed_files", lambda *a: "nowhere")
    monkeypatch.setattr(lakes, "state_buckets", lambda *a: 9)
    lakes.loaded_lake(spark, str(tmp_path))
    assert [job for job, _ in seen][-1] == "run_gold" and {n for _, n in seen} == {"9"}
