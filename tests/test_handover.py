import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cdclake.operators.handover import Mark, snapshot_changes, tail
from cdclake.sources import lake as lk
from conftest import rows
from util import ITEM, changes, table

SPEC = replace(ITEM, seq_column="lsn")


def positioned(spark, data):
    """(id, name, qty, op, ts, lsn) as changes."""
    base = changes(spark, [r[:5] for r in data])
    lsn = F.element_at(F.create_map(*[F.lit(x) for r in data for x in (f"{r[0]}|{r[1]}", r[5])]), F.concat_ws("|", "id", "name"))
    return base.withColumn("lsn", lsn.cast("long")).select(*SPEC.change_schema.fieldNames())


def history(seed):
    """Every state of a table of few keys, change by change: (id, name, qty, op, ts, lsn)."""
    r, out, live = random.Random(seed), [], set()
    for lsn in range(1, 60):
        key = r.randrange(8)
        op = "d" if key in live and r.random() < 0.4 else ("u" if key in live else "c")
        live = live - {key} if op == "d" else live | {key}
        out.append((key, f"v{lsn}", lsn, op, lsn // 5, lsn))
    return out


def state_at(log, lsn):
    state = {}
    for r in log:
        if r[5] <= lsn:
            state.pop(r[0], None)
            if r[3] != "d":
                state[r[0]] = r[:3]
    return state


@pytest.mark.parametrize("seed", range(4))
def test_any_read_between_mark_and_end_gives_the_same(spark, lake, seed):
    """Rows are read one by one at any position behind the mark; the log starts before the mark."""
    log, r = history(seed), random.Random(seed + 100)
    mark = Mark(position=20, ts_ms=20 // 5)
    read = {}
    for key in range(8):  # each key as it stands when it is read
        row = state_at(log, r.randrange(20, 45)).get(key)
        if row:
            read[key] = row
    snapshot = snapshot_changes(table(spark, list(read.values())), SPEC, mark, "2024-01-01")
    behind = tail(positioned(spark, [x for x in log if x[5] > 10]), SPEC, mark)
    assert behind.where("lsn <= 20").count() == 0
    want = sorted(state_at(log, 99).values())
    for order in ((snapshot, behind), (behind, snapshot), (behind.unionByName(snapshot),)):
        own = lk.Lake(spark, lake.root, f"{lake.prefix}{len(order)}{order[0] is snapshot}", state_buckets=4)
        lk.create_layers(own, [SPEC])
        for part in order:
            lk.apply_changes(own, part, SPEC)
        assert rows(lk.scan_silver(own, SPEC)) == want


def test_chunks_with_marks_of_their_own(spark):
    log = history(9)
    marks = {0: 15, 1: 30}  # even keys are read behind 15, odd ones behind 30
    read = [state_at(log, marks[k % 2] + 3)[k] for k in range(8) if k in state_at(log, marks[k % 2] + 3)]
    position = F.when(F.col("id") % 2 == 0, 15).otherwise(30)
    first = Mark(15, 3)
    snapshot = snapshot_changes(table(spark, read), SPEC, first, "2024-01-01", position, F.floor(position / 5))
    everything = snapshot.unionByName(tail(positioned(spark, log), SPEC, first))
    from cdclake.operators.merge import as_state, current_rows, merge_state

    empty = as_state(everything.limit(0), SPEC)
    assert rows(current_rows(merge_state(empty, everything, SPEC), SPEC)) == sorted(state_at(log, 99).values())


def test_marks_are_kept_with_the_log(spark, lake):
    lk.create_layers(lake, [SPEC])
    assert lk.hand_over_mark(lake, SPEC) is None
    lk.begin_hand_over(lake, SPEC, Mark(7, 70))
    lk.begin_hand_over(lake, SPEC, Mark(7, 70))  # a restart of the same snapshot
    assert lk.hand_over_mark(lake, SPEC) == Mark(7, 70)
    with pytest.raises(ValueError, match="begun"):
        lk.begin_hand_over(lake, SPEC, Mark(8, 80))
    lk.begin_hand_over(lake, SPEC, Mark(8, 80), anew=True)
    assert lk.hand_over_mark(lake, SPEC) == Mark(8, 80)
    with pytest.raises(ValueError, match="seq_column"):
        tail(changes(spark, []), ITEM, Mark(1, 1))
