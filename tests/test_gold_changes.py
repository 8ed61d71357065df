"""Marts that follow the changed rows are those made from all rows."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cdclake.operators.mart_sums import MART_SUMS, MartSums, signed_images
from cdclake.plans.jobs import MART_JOBS, JobFailed, run_gold
from cdclake.sources import gold
from cdclake.sources import lake as lk
from cdclake.sources.ledger import location
from cdclake.specs import MARTS, entity
from conftest import rows
from util import ITEM, at, changes, table

PNR, PAY, SEG = entity("pnr_records"), entity("payments"), entity("flight_segments")
SPECS = {s.name: s for s in (PNR, PAY, SEG)}
DAYS = [at(f"2024-01-0{d} 10:00:00") for d in range(1, 7)]


@pytest.fixture
def by_day(lake):
    lake = replace(lake, gold_by_day=True)
    lk.create_layers(lake, SPECS.values())
    return lake


def merge(spark, lake, ts, pnr=(), pay=(), seg=()):
    """(key, op, values…) of each table, all of one source time."""
    if pnr:
        full = [(k, channel, status, created, created, op, ts) for k, op, channel, status, created in pnr]
        lk.apply_changes(lake, changes(spark, full, PNR), PNR)
    if pay:
        amounts = {r[0]: r[4] for r in pay}
        full = [(k, p, "CASH", None, "VND", status, created, created, op, ts) for k, op, p, status, _, created in pay]
        known = spark.createDataFrame([(k, a) for k, a in amounts.items()], "payment_id string, value string")
        log = changes(spark, full, PAY).join(known, "payment_id")
        log = log.withColumn("amount", F.col("value").cast(PAY.schema["amount"].dataType)).drop("value")
        lk.apply_changes(lake, log, PAY)
    if seg:
        full = [(k, p, a, b, day, "VN", "VN1", DAYS[0], DAYS[0], op, ts) for k, op, p, a, b, day in seg]
        lk.apply_changes(lake, changes(spark, full, SEG), SEG)


def agrees(lake):
    for mart, (schema, _) in MARTS.items():
        names = schema.fieldNames()
        assert rows(lake.scan(lake.gold(mart)), *names) == rows(MART_JOBS[mart](lake, SPECS), *names), mart


def first_load(spark, lake):
    merge(
        spark, lake, 1,
        pnr=[("A", "c", "WEB", "CREATED", DAYS[0]), ("B", "c", "APP", "CANCELLED", DAYS[1]), ("C", "c", None, "CREATED", None)],
        pay=[("p", "c", "A", "SUCCESS", "100.00", DAYS[0]), ("q", "c", "B", "FAILED", None, DAYS[1]), ("r", "c", "C", "SUCCESS", "0.01", DAYS[2])],
        seg=[(1, "c", "A", "HAN", "SGN", dt.date(2024, 2, 1)), (2, "c", "A", "SGN", "HAN", dt.date(2024, 2, 2)),
             (3, "c", "A", "HAN", "SGN", dt.date(2024, 2, 3)), (4, "c", "B", "HAN", "DAD", dt.date(2024, 2, 4)),
             (5, "c", None, "HAN", "DAD", dt.date(2024, 2, 4))],
    )


def counts(results):
    return {r.item: dict(r.counts) for r in results}


def files(spark, lake, mart):
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location(spark, lake.gold(mart)))
    found = {}
    for r in names.select("path", "modificationTime").collect():
        found.setdefault(r.path.split("/")[-2], set()).add((r.path, r.modificationTime))
    return found


def test_only_changed_days_are_written(spark, by_day):
    first_load(spark, by_day)
    assert all(c["whole"] == 1 for c in counts(run_gold(by_day, specs=SPECS, changed_only=True)).values())
    agrees(by_day)
    before = {m: files(spark, by_day, m) for m in MARTS}
    # B is paid after all, so its route appears; r loses its amount; one leg of A moves by a day.
    merge(
        spark, by_day, 2,
        pay=[("q", "u", "B", "SUCCESS", "7.77", DAYS[1]), ("r", "u", "C", "SUCCESS", None, DAYS[2])],
        seg=[(3, "u", "A", "HAN", "SGN", dt.date(2024, 2, 5))],
    )
    done = counts(run_gold(by_day, specs=SPECS, changed_only=True))
    agrees(by_day)
    assert done["daily_booking_summary"] == {"days": 0, "whole": 0}
    assert done["payment_status_summary"] == {"days": 2, "whole": 0}
    assert done["revenue_by_route"] == {"days": 3, "whole": 0}  # the days left, reached and newly paid
    after = {m: files(spark, by_day, m) for m in MARTS}
    assert before["daily_booking_summary"] == after["daily_booking_summary"]
    old, new = before["revenue_by_route"], after["revenue_by_route"]
    assert "flight_date=2024-02-03" not in new
    for day in ("flight_date=2024-02-01", "flight_date=2024-02-02"):
        assert old[day] == new[day]
    assert counts(run_gold(by_day, specs=SPECS, changed_only=True))["revenue_by_route"] == {"days": 0, "whole": 0}
    hidden = rows(lk.list_tables(by_day, ["silver"]), "table_name")
    assert not [n for (n,) in hidden if "_sums_" in n]


def test_deletes_unknown_days_and_whole_writes(spark, by_day):
    first_load(spark, by_day)
    run_gold(by_day, specs=SPECS, changed_only=True)
    merge(spark, by_day, 2, pnr=[("C", "d", None, "CREATED", None)], pay=[("p", "d", "A", "SUCCESS", "100.00", DAYS[0])])
    run_gold(by_day, specs=SPECS, changed_only=True)
    agrees(by_day)
    # Made whole in between: what the sums say no longer counts.
    merge(spark, by_day, 3, pnr=[("A", "u", "APP", "CANCELLED", DAYS[0])])
    run_gold(by_day, specs=SPECS)
    merge(spark, by_day, 4, pnr=[("A", "u", "WEB", "CREATED", DAYS[0])])
    assert counts(run_gold(by_day, specs=SPECS, changed_only=True))["daily_booking_summary"]["whole"] == 1
    agrees(by_day)


def test_a_run_that_broke_off_is_mended(spark, by_day, monkeypatch):
    first_load(spark, by_day)
    run_gold(by_day, specs=SPECS, changed_only=True)
    merge(spark, by_day, 2, pnr=[("A", "u", "APP", "CANCELLED", DAYS[0])])

    def half(lake, rows_, mart, day, days):
        lake.spark.sql(f"ALTER TABLE {lake.gold(mart)} DROP IF EXISTS PARTITION ({day} = '{days[0].isoformat()}')")
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(gold, "_replace_days", half)
        with pytest.raises(JobFailed):
            run_gold(by_day, "daily_booking_summary", specs=SPECS, changed_only=True)
    # Back to what it was: no row differs from the recorded snapshot, yet gold must be written.
    merge(spark, by_day, 3, pnr=[("A", "u", "WEB", "CREATED", DAYS[0])])
    run_gold(by_day, specs=SPECS, changed_only=True)
    agrees(by_day)


def test_snapshots_are_compared_in_place(spark, by_day):
    first_load(spark, by_day)
    old = lk.published_snapshot(by_day, PNR)
    merge(spark, by_day, 2, pnr=[("A", "u", "APP", "CANCELLED", DAYS[0])])
    new = lk.published_snapshot(by_day, PNR)
    images = signed_images(
        lk.scan_snapshot(by_day, PNR, old), lk.scan_snapshot(by_day, PNR, new), PNR.pk, ["booking_channel"]
    )
    assert rows(images) == [(-1, "WEB"), (1, "APP")]
    plan = images._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ticketing_deadline" not in plan and "booking_status" not in plan


def test_snapshots_that_are_gone(spark, by_day):
    first_load(spark, by_day)
    run_gold(by_day, specs=SPECS, changed_only=True)
    for ts in (2, 3, 4):
        merge(spark, by_day, ts, pnr=[("A", "u", "APP", "CREATED", DAYS[ts])])
    done = counts(run_gold(by_day, specs=SPECS, changed_only=True))
    assert done["daily_booking_summary"]["whole"] == 1 and done["payment_status_summary"] == {"days": 0, "whole": 0}
    agrees(by_day)


def test_random_changes(spark, lake):
    """Marts that are not partitioned by day."""
    lk.create_layers(lake, SPECS.values())
    rnd = random.Random(7)
    for ts in range(1, 4):
        pick = lambda ids: rnd.sample(ids, 12 if ts == 1 else 5)
        op = lambda: rnd.choice(["c", "u", "u", "d"] if ts > 1 else ["c"])
        day = lambda: rnd.choice([*DAYS, None])
        book = lambda: rnd.choice([None, *"ABCDE"])
        amount = lambda: rnd.choice([None, "0.01", "10.00", "33.33", "-5.00"])
        place = lambda: rnd.choice(["HAN", "SGN", None])
        flight = lambda: rnd.choice([dt.date(2024, 2, 1), dt.date(2024, 2, 2), None])
        status = lambda kinds: rnd.choice([*kinds, None])
        merge(
            spark, lake, ts,
            pnr=[(k, op(), rnd.choice(["WEB", None]), status(["CANCELLED", "CREATED"]), day()) for k in pick(list("ABCDEFGHIJKLMN"))],
            pay=[(k, op(), book(), status(["SUCCESS", "FAILED"]), amount(), day()) for k in pick(list("abcdefghijklmn"))],
            seg=[(k, op(), book(), place(), place(), flight()) for k in pick(list(range(14)))],
        )
        run_gold(lake, specs=SPECS, changed_only=True)
        agrees(lake)


def test_sums_are_made_from_old_rows_only_for_few_bookings(spark, lake, monkeypatch):
    """With most bookings touched the old rows are not added up again; their sums are held."""
    lk.create_layers(lake, SPECS.values())
    ids = "ABCDEFGHIJ"
    day = dt.date(2024, 2, 1)
    merge(
        spark, lake, 1,
        pay=[(k.lower(), "c", k, "SUCCESS", "10.00", DAYS[0]) for k in ids],
        seg=[(i, "c", k, "HAN", "SGN", day) for i, k in enumerate(ids)],
    )
    run_gold(lake, "revenue_by_route", specs=SPECS, changed_only=True)
    made, whole = [], MartSums.whole
    monkeypatch.setattr(MartSums, "whole", lambda self, tables: made.append(1) or whole(self, tables))

    def again(ts, keys):
        made.clear()
        merge(
            spark, lake, ts,
            pay=[(k.lower(), "u", k, "SUCCESS" if k != "A" else "FAILED", f"{ts}.50", DAYS[0]) for k in keys],
            seg=[(0, "d", "A", "HAN", "SGN", day), (5, "u", "F", "HAN", "DAD", day)] if len(keys) > 1 else [],
        )
        (done,) = run_gold(lake, "revenue_by_route", specs=SPECS, changed_only=True)
        names = MARTS["revenue_by_route"][0].fieldNames()
        assert rows(lake.scan(lake.gold("revenue_by_route")), *names) == rows(MART_JOBS["revenue_by_route"](lake, SPECS), *names)
        assert dict(done.counts) == {"days": 1, "whole": 0}
        return len(made)

    assert again(2, "C") == 2
    assert again(3, ids) == 1
    assert again(4, "BD") == 2


def test_images(spark):
    old = table(spark, [(1, "a", 1), (2, "b", None), (3, "c", 3), (4, None, 4)])
    new = table(spark, [(1, "a", 9), (2, "b", None), (4, "d", 4), (5, "e", 5)])
    assert rows(signed_images(old, new, "id", ["name"])) == sorted([(-1, "c"), (-1, None), (1, "d"), (1, "e")], key=repr)
    assert rows(signed_images(old, old, ITEM.pk, ["name", "qty"])) == []


def test_sums_cover_the_marts():
    assert MART_SUMS.keys() == MARTS.keys() == MART_JOBS.keys()
    assert all(m.day == MARTS[name][1] for name, m in MART_SUMS.items())
