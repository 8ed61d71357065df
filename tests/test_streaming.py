import json

import pytest

from pyspark.sql import functions as F

from cdclake.sources import lake as lk
from cdclake.sources.change_files import read_changes, write_change_files
from cdclake.streaming.capture import stream_bronze, stream_changes, topic_pattern
from cdclake.streaming.upsert import stream_change_files, stream_silver
from conftest import rows
from util import ITEM, VERSIONED, changes

ONCE = {"availableNow": True}


def envelope(key, name, op, ts, arrived="2024-01-01T12:00:00Z", topic="cdc.shop.dbo.items"):
    row = {"id": key, "name": name, "qty": 1}
    return json.dumps(
        {
            "before": row if op == "d" else None,
            "after": None if op == "d" else row,
            "source": {"ts_ms": ts, "table": "items"},
            "op": op,
            "ts_ms": ts,
            "topic": topic,
            "timestamp": arrived,
        }
    )


def run(spark, tmp_path):
    query = stream_bronze(
        spark,
        "json",
        {"path": str(tmp_path / "in"), "maxFilesPerTrigger": "1"},
        ITEM,
        str(tmp_path / "out"),
        str(tmp_path / "ckpt"),
        ONCE,
        max_records=1,
    )
    query.awaitTermination()
    return read_changes(spark, str(tmp_path / "out"), ITEM)


def test_capture_resumes_where_it_stopped(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    tombstone = json.dumps({"topic": "cdc.shop.dbo.items", "timestamp": "2024-01-01T12:00:00Z"})
    other = envelope(9, "x", "c", 1, topic="cdc.shop.dbo.items_old")
    (source / "1.json").write_text(
        "\n".join([envelope(1, "a", "c", 1), envelope(1, "a", "d", 2), tombstone, other])
    )
    assert rows(run(spark, tmp_path), "id", "__op", "__deleted", "event_date") == [
        (1, "c", "false", "2024-01-01"),
        (1, "d", "true", "2024-01-01"),
    ]
    late = envelope(2, "b", "u", 0, "2024-01-01T23:59:59.999Z")
    (source / "2.json").write_text("\n".join([late, envelope(3, "c", "r", 5, "2024-01-02T00:00:00Z")]))
    got = run(spark, tmp_path)
    assert rows(got, "id", "__op", "event_date") == [
        (1, "c", "2024-01-01"),
        (1, "d", "2024-01-01"),
        (2, "u", "2024-01-01"),
        (3, "r", "2024-01-02"),
    ]
    assert run(spark, tmp_path).count() == 4


def test_upserts_across_batches_and_a_restart_equal_one_batch(spark, lake, tmp_path):
    root = str(tmp_path / "raw")
    lk.create_silver(lake, [ITEM])

    def merge():
        stream = stream_change_files(spark, root, ITEM, maxFilesPerTrigger="1")
        stream_silver(stream, ITEM, lake, str(tmp_path / "ckpt"), ONCE).awaitTermination()
        return rows(lk.scan_silver(lake, ITEM))

    first = [(1, "a", 1, "c", 1), (2, "b", 1, "c", 1), (2, "b", 1, "d", 9), (3, "c", 1, None, 1)]
    write_change_files(changes(spark, first).where("__op IS NOT NULL"), root, ITEM)
    assert merge() == [(1, "a", 1)]
    second = [(1, "stale", 1, "u", 0), (2, "zombie", 1, "u", 5), (4, "d", 1, "r", 2)]
    write_change_files(changes(spark, second).withColumn("event_date", F.lit("2024-01-02")), root, ITEM)
    assert merge() == [(1, "a", 1), (4, "d", 1)]
    assert merge() == [(1, "a", 1), (4, "d", 1)]


class FakeReader:
    """Records what a stream reader is asked for."""

    def __init__(self, loaded):
        self.calls, self.loaded = {}, loaded

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls.update(options)
        return self

    def load(self):
        return self.loaded


def test_kafka_options_and_parsing(spark):
    value = bytearray(envelope(1, "a", "c", 1).encode())
    message = spark.createDataFrame(
        [("cdc.shop.dbo.items", None, value, 3)],
        "topic string, timestamp timestamp, value binary, partition int",
    )
    session = type("Session", (), {"readStream": FakeReader(message)})()
    pattern = topic_pattern("cdc.shop.dbo", ["items", "orders"])
    assert pattern == r"cdc\.shop\.dbo\.(items|orders)"
    got = stream_changes(session, "kafka", {"subscribePattern": pattern}, ITEM)
    assert session.readStream.calls == {
        "format": "kafka",
        "startingOffsets": "earliest",
        "subscribePattern": pattern,
    }
    assert rows(got, "topic", "after.id", "op") == [("cdc.shop.dbo.items", 1, "c")]


def test_parquet_silver_refuses_frequent_triggers(spark, lake):
    from cdclake.streaming.upsert import stream_silver

    with pytest.raises(ValueError, match="availableNow"):
        stream_silver(None, ITEM, lake, "unused", {"processingTime": "5 seconds"})


def test_a_replayed_batch_is_skipped(spark, lake, tmp_path):
    from cdclake.streaming.upsert import query_id

    root, checkpoint = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    lk.create_silver(lake, [ITEM])

    def merge(checkpoint=checkpoint):
        stream_silver(stream_change_files(spark, root, ITEM), ITEM, lake, checkpoint, ONCE).awaitTermination()
        return query_id(spark, checkpoint)

    write_change_files(changes(spark, [(1, "a", 1, "c", 1)]), root, ITEM)
    query = merge()
    assert lk.merged_batch(lake, ITEM, query) == 0 and lk.merged_batch(lake, ITEM, "other") is None
    version, files = lk._version(lake, ITEM), lk.read_state(lake, ITEM).inputFiles()
    newer = changes(spark, [(1, "b", 2, "u", 9)])
    assert lk.apply_changes(lake, newer, ITEM, batch=(query, 0)) is False
    assert (lk._version(lake, ITEM), lk.read_state(lake, ITEM).inputFiles()) == (version, files)
    # The commit log is lost with the last entry: the query hands in its batch again.
    (tmp_path / "ckpt" / "commits" / "0").unlink()
    for crc in (tmp_path / "ckpt" / "commits").glob(".0*"):
        crc.unlink()
    assert merge() == query and lk._version(lake, ITEM) == version
    write_change_files(newer.withColumn("event_date", F.lit("2024-01-02")), root, ITEM)
    assert merge() == query and lk.merged_batch(lake, ITEM, query) == 1
    assert rows(lk.scan_silver(lake, ITEM)) == [(1, "b", 2)]
    # A new checkpoint is a new query, whose batches count anew.
    other = merge(str(tmp_path / "ckpt2"))
    assert other != query and lk.merged_batch(lake, ITEM, other) == 0
    assert lk.merged_batch(lake, ITEM, query) == 1


def put(folder, name, messages):
    """A file of (topic, partition, offset, timestamp, value) messages as JSON lines."""
    keys = ("topic", "partition", "offset", "timestamp", "value")
    (folder / name).write_text("\n".join(json.dumps(dict(zip(keys, m, strict=True))) for m in messages))


def test_dead_letters_go_aside_and_the_stream_goes_on(spark, tmp_path):
    from cdclake.streaming.messages import capture_all, captured_changes, dead_letters, stream_messages

    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    at_, topic = "2024-01-01T12:00:00Z", "cdc.shop.dbo.items"

    def image(op="c", before=None, after=None, **more):
        return json.dumps({"op": op, "before": before, "after": after, "source": {"ts_ms": 5, "table": "items"}, "ts_ms": 5} | more)

    row = {"id": 1, "name": "a", "qty": 1}

    def run_once():
        messages = stream_messages(spark, "json", {"path": str(source), "maxFilesPerTrigger": "1"})
        capture_all(messages, [ITEM, VERSIONED], root, str(tmp_path / "ckpt"), ONCE).awaitTermination()

    put(source, "1.json", [
        (topic, 0, 1, at_, image(after=row)),
        (topic, 0, 2, at_, "{not json"),
        (topic, 0, 3, at_, '"a text"'),
        (topic, 0, 4, at_, image(after=row | {"id": "one"})),
        (topic, 0, 5, at_, image(op=None, after=row)),
        (topic, 0, 6, at_, image(op="d", after=row)),
        (topic, 0, 7, at_, image(op="u", before=row)),
        (topic, 0, 8, at_, None),
        ("cdc.shop.dbo.others", 0, 9, at_, image(after=row)),
        ("cdc.shop.dbo.versioned", 2, 10, at_, image(after={"id": 7, "name": "v", "updated_at": 1704067200000})),
        (topic, 0, 11, at_, image(op="d", before=row, later_field=[1, 2])),
        (topic, 0, 12, at_, image(after={"id": 5})),
        (topic, 0, 13, at_, ""),
    ])
    run_once()
    assert rows(captured_changes(spark, root, ITEM), "id", "name", "__op", "__deleted", "event_date") == [
        (1, "a", "c", "false", "2024-01-01"),
        (1, "a", "d", "true", "2024-01-01"),
        (5, None, "c", "false", "2024-01-01"),
    ]
    assert rows(captured_changes(spark, root, VERSIONED), "id", F.unix_millis("updated_at")) == [(7, 1704067200000)]
    aside = dead_letters(spark, root)
    assert rows(aside, "offset", "reason") == [
        (13, "json"), (2, "json"), (3, "json"), (4, "type"), (5, "code"), (6, "image"), (7, "image"), (9, "table"),
    ]
    assert rows(aside.where("offset = 2"), "topic", "partition", "raw", "event_date") == [(topic, 0, "{not json", "2024-01-01")]
    run_once()  # nothing new
    put(source, "2.json", [(topic, 1, 14, "2024-01-02T00:00:00Z", image(after=row | {"id": 2})), (topic, 1, 15, at_, "x")])
    run_once()
    assert rows(captured_changes(spark, root, ITEM, ["2024-01-02"]), "id") == [(2,)]
    assert captured_changes(spark, root, ITEM).count() == 4 and dead_letters(spark, root).count() == 9
    stray = tmp_path / "out" / "__sink=dead_letters" / "event_date=2024-01-01"
    (stray / "part-of-a-failed-batch.parquet").write_bytes(next(stray.glob("*.parquet")).read_bytes())
    assert dead_letters(spark, root).count() == 9  # only what was committed counts



def test_captured_changes_reach_silver(spark, lake, tmp_path):
    from cdclake.plans.jobs import run_silver
    from cdclake.streaming.messages import capture_all, captured_changes, stream_messages

    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    messages = [
        ("cdc.shop.dbo.items", 0, i, "2024-01-01T12:00:00Z", envelope(i % 3, f"n{i}", "u", i)) for i in range(9)
    ]
    put(source, "1.json", [*messages, ("cdc.shop.dbo.items", 0, 99, "2024-01-01T12:00:00Z", "broken")])
    capture_all(stream_messages(spark, "json", {"path": str(source)}), [ITEM], root, str(tmp_path / "ckpt"), ONCE).awaitTermination()
    lk.create_layers(lake, [ITEM])
    lk.append_bronze(lake, captured_changes(spark, root, ITEM, ["2024-01-01"]), ITEM, idempotent=True, day="2024-01-01")
    run_silver(lake, specs={"items": ITEM})
    assert rows(lk.scan_silver(lake, ITEM)) == [(0, "n6", 1), (1, "n7", 1), (2, "n8", 1)]
