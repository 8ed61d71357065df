import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from cdclake.operators.merge import as_state, current_rows, merge_changes, merge_state
from conftest import rows
from util import ITEM, changes, table


def test_every_merge_outcome(spark):
    target = table(spark, [(1, "kept", 1), (2, "to update", 1), (3, "to delete", 1), (6, "nullop", 1)])
    log = changes(
        spark,
        [
            (2, "updated", None, "u", 10),
            (3, "to delete", 1, "d", 10),
            (4, "inserted", 4, "c", 10),
            (5, "unknown", 1, "d", 10),
            (6, "ignored", 1, None, 10),
            (7, "snapshot", 7, "r", 10),
            (None, "no key", 1, "c", 10),
        ],
    )
    assert rows(merge_changes(target, log, ITEM)) == [
        (1, "kept", 1),
        (2, "updated", None),
        (4, "inserted", 4),
        (6, "nullop", 1),
        (7, "snapshot", 7),
    ]


def test_changes_without_code_are_ignored(spark):
    log = changes(spark, [(1, "older", 1, "u", 5), (1, "newest", 1, None, 10), (2, "none", 1, None, 3)])
    assert rows(merge_changes(table(spark, []), log, ITEM)) == [(1, "older", 1)]
    assert rows(merge_changes(table(spark, [(1, "was", 1)]), log, ITEM)) == [(1, "older", 1)]


def test_merging_again_changes_nothing(spark):
    log = changes(spark, [(1, "a", 1, "c", 1), (1, "b", 1, "u", 2), (2, "x", 1, "d", 1)])
    once = merge_changes(table(spark, [(2, "x", 1), (3, "y", 1)]), log, ITEM)
    assert rows(merge_changes(once, log, ITEM)) == rows(once) == [(1, "b", 1), (3, "y", 1)]


def test_small_change_set_leaves_target_unshuffled(spark, tmp_path):
    spark.range(1000).selectExpr("id", "'n' AS name", "1 AS qty").write.parquet(str(tmp_path / "t"))
    changes(spark, [(1, "a", 1, "u", 1)]).write.parquet(str(tmp_path / "c"))
    log = spark.read.parquet(str(tmp_path / "c"))
    merged = merge_changes(spark.read.parquet(str(tmp_path / "t")), log, ITEM)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan
    assert merged.count() == 1000


def state_of(spark, data):
    return merge_state(as_state(changes(spark, []), ITEM), changes(spark, data), ITEM)


def test_late_older_change_does_not_win(spark):
    state = state_of(spark, [(1, "new", 1, "u", 20), (2, "gone", 1, "d", 20), (3, "x", 1, "u", 20)])
    late = changes(
        spark,
        [
            (1, "old", 1, "u", 10),
            (2, "zombie", 1, "u", 10),
            (3, "no time", 1, "u", None),
            (4, "no time", 1, "u", None),
        ],
    )
    after = merge_state(state, late, ITEM)
    assert rows(current_rows(after, ITEM)) == [(1, "new", 1), (3, "x", 1), (4, "no time", 1)]
    newer = merge_state(after, changes(spark, [(2, "again", 2, "c", 30)]), ITEM)
    assert (2, "again", 2) in rows(current_rows(newer, ITEM))


def test_change_without_code_never_enters_state(spark):
    state = state_of(spark, [(1, "a", 1, "u", 1), (1, "b", 1, None, 2)])
    assert rows(current_rows(state, ITEM)) == [(1, "a", 1)]


def fold(data):
    """What the state should show, by plain Python."""
    rank = {"r": 0, "c": 1, "u": 2, "d": 3}

    def age(row):
        _, name, qty, op, ts = row
        low = [(v is not None, v if v is not None else 0) for v in (ts, rank[op])]
        return (*low, (name is not None, name or ""), (qty is not None, qty or 0))

    best = {}
    for row in data:
        if row[3] is not None and (row[0] not in best or age(row) > age(best[row[0]])):
            best[row[0]] = row
    return sorted((r[:3] for r in best.values() if r[3] != "d"), key=repr)


CHANGE = st.tuples(
    st.integers(1, 4),
    st.sampled_from(["a", "b", None]),
    st.sampled_from([1, 2, None]),
    st.sampled_from(["r", "c", "u", "d", None]),
    st.sampled_from([1, 2, 3, None]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(CHANGE, max_size=14), cut=st.integers(0, 14), swap=st.booleans())
def test_batches_in_any_order_equal_one_fold(spark, data, cut, swap):
    parts = [data[:cut], data[cut:]]
    if swap:
        parts.reverse()
    state = as_state(changes(spark, []), ITEM)
    for part in [*parts, parts[0]]:  # the first batch is replayed at the end
        state = merge_state(state, changes(spark, part), ITEM)
    live = rows(current_rows(state, ITEM))
    assert live == fold(data)
    assert len({r[0] for r in live}) == len(live)


@pytest.mark.parametrize("n", [0, 1])
def test_empty_sides(spark, n):
    log = changes(spark, [(1, "a", 1, "c", 1)][:n])
    assert len(rows(merge_changes(table(spark, []), log, ITEM))) == n


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 3), st.sampled_from("crud"), st.integers(0, 9)), max_size=14),
    st.lists(st.integers(0, 10), min_size=3, max_size=3),
)
def test_forgetting_old_deletes_changes_nothing_for_input_above_the_mark(spark, log, marks):
    """Batches merged with a rising mark; what lies below the mark of its batch is left out on both sides."""
    marks = sorted(marks)
    data = [(k, f"{i}", i, op, ts) for i, (k, op, ts) in enumerate(log)]
    state = whole = as_state(changes(spark, []), ITEM)
    for i, mark in enumerate(marks):
        part = changes(spark, data[i::3])
        state = merge_state(state, part, ITEM, oldest=mark)
        whole = merge_state(whole, part.where(F.col("__source_ts_ms") >= mark), ITEM)
        assert state.where((F.col("__op") == "d") & (F.col("__source_ts_ms") < mark)).isEmpty()
    assert rows(current_rows(state, ITEM)) == rows(current_rows(whole, ITEM))
