"""Periodic runs of words: stretches that repeat a period several times, found in suffix arrays.

The words of a step's texts are sorted as suffixes by doubling the compared length; only suffixes that still
share their words with another one are sorted again, and the ranks of every round are kept: they answer how far
two suffixes agree. That gives the suffix array, its inverse and the lengths that neighbours share (LCP), and the
LCP intervals follow from the next smaller value on either side, so no tree is built.

Branching tandems: an interval of depth d holds all places of one stretch of d words. For every place i in it, but
for those in its largest child, the place d words on and d words back is looked up in the inverse array: if it lies
in the interval, though not in the same child, a square starts there that cannot be rotated to the right.
Rotating it to the left as far as it stays a square gives the run's start; all squares with the same ends
are one run, the shortest their period. Every run ends in such a square, so none is missed.

Defined cases. A null or empty text has no words and no run, and collapses to an empty text. Words are compared as
they are, without folding cases. Repeated rows give repeated results; an empty table gives no rows. Columns other
than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm.common import steps
from llm.text import words

#: Bytes of text sorted at once; a longer text is a step of its own.
STEP = 1 << 20
RUNS = "array<struct<start:long,length:long,period:long>>"


@dataclass
class Suffixes:
    """order: the suffix array; rank: its inverse; levels[k]: ranks by the first 2^k words; end: of the text."""

    order: np.ndarray
    rank: np.ndarray
    levels: list[np.ndarray]
    end: np.ndarray

    def agree(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words the suffixes at i and j (i < j, in one text) share."""
        shared = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        for k in reversed(range(len(self.levels))):
            level = self.levels[k]
            a, b = i[live] + shared[live], j[live] + shared[live]
            inside = np.maximum(a, b) < self.end[j[live]]
            size = len(level) - 1
            same = inside & (level[np.minimum(a, size)] == level[np.minimum(b, size)])
            shared[live] += same.astype(np.int64) << k
        return shared


def suffixes(codes: np.ndarray, first: np.ndarray) -> Suffixes:
    """The suffixes of all rows' words; row r has the words first[r] to first[r + 1]."""
    n = len(codes)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:][row]
    key = row * (int(codes.max()) + 1 if n else 1) + codes
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    slots, levels, width = np.arange(n), [], 1
    sorted_key, placed = key[order], order
    while True:
        new = np.ones(len(slots), bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(slots)))
        rank[placed] = np.repeat(slots[starts], sizes)
        order[slots] = placed
        levels.append(rank.astype(np.int32))
        tied = np.repeat(sizes > 1, sizes)
        slots, placed = slots[tied], placed[tied]
        if not len(slots):
            return Suffixes(order, rank, levels, end)
        # Where the text ends, nothing follows: smaller than any rank.
        behind = placed + width
        follow = np.where(behind < end[placed], rank[np.minimum(behind, n - 1)] + 1, 0)
        key = rank[placed] * (n + 1) + follow
        by = np.argsort(key, kind="stable")
        sorted_key, placed = key[by], placed[by]
        width *= 2


def shared_lengths(s: Suffixes) -> np.ndarray:
    """For each place in the suffix array, how many words its suffix shares with the one before."""
    lcp = np.zeros(len(s.order), np.int64)
    if len(lcp) < 2:
        return lcp
    same = 1 + np.flatnonzero(s.levels[0][s.order[1:]] == s.levels[0][s.order[:-1]])
    a, b = s.order[same - 1], s.order[same]
    lcp[same] = s.agree(np.minimum(a, b), np.maximum(a, b))
    return lcp


def _reach(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The widest stretch around each place in which no value is smaller, both ends included."""
    n = len(lcp)
    lows = [lcp]  # lows[k][i]: the smallest of the 2^k values from i on
    longest = int(np.diff(np.flatnonzero(np.concatenate([[True], lcp == 0, [True]]))).max())
    while (2 << (len(lows) - 1)) <= longest:
        half = 1 << (len(lows) - 1)
        lows.append(np.minimum(lows[-1][:-half], lows[-1][half:]))
    value = lcp[at]
    left, right = at.copy(), at.copy()
    for k in reversed(range(len(lows))):
        size, low = 1 << k, lows[k]
        start = left - size
        go = (start >= 0) & (low[np.maximum(start, 0)] >= value)
        left = np.where(go, start, left)
        start = right + 1
        go = (start + size <= n) & (low[np.minimum(start, len(low) - 1)] >= value)
        right = np.where(go, right + size, right)
    return left, right


def branching_tandems(s: Suffixes, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, depth) of all squares of `depth` words and `depth` more that cannot be rotated to the right."""
    at = np.flatnonzero(lcp > 0)
    none = np.zeros(0, np.int64)
    if not len(at):
        return none, none
    left, right = _reach(lcp, at)
    low, high, depth = left - 1, right + 1, lcp[at]  # an interval is the places low to high - 1
    by = np.lexsort((at, depth, low))
    at, low, high, depth = at[by], low[by], high[by], depth[by]
    new = np.ones(len(at), bool)
    new[1:] = (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])
    starts = np.flatnonzero(new)
    interval = np.cumsum(new) - 1
    # Values equal to the depth part the interval into children, one more than there are of them.
    begin = np.where(new, low, np.concatenate([[0], at[:-1]]))
    last = np.append(starts[1:], len(at)) - 1
    begin, end = np.concatenate([begin, at[last]]), np.concatenate([at, high[last]])
    owner = np.concatenate([interval, np.arange(len(starts))])
    by = np.lexsort((begin, end - begin, owner))
    begin, end, owner = begin[by], end[by], owner[by]
    smaller = np.append(owner[1:] == owner[:-1], False)  # all children but the largest
    begin, end, owner = begin[smaller], end[smaller], owner[smaller]
    first = np.concatenate([[0], np.cumsum(end - begin)])
    found = []
    child = 0
    while child < len(begin):  # in portions, for memory
        stop = max(child + 1, int(np.searchsorted(first, first[child] + (1 << 20), "right")) - 1)
        size = end[child:stop] - begin[child:stop]
        which = np.repeat(np.arange(child, stop), size)
        place = begin[which] + np.arange(len(which)) - (first[which] - first[child])
        i, d = s.order[place], depth[starts[owner[which]]]
        text_end = s.end[i]
        for j in (i + d, i - d):
            ok = (j >= 0) & (j < text_end)
            r = s.rank[np.where(ok, j, i)]
            # In the interval, so in the same text too.
            ok &= (low[starts[owner[which]]] <= r) & (r < high[starts[owner[which]]])
            ok &= (r < begin[which]) | (r >= end[which])
            found.append((np.minimum(i, j)[ok], d[ok]))
        child = stop
    start, depth = (np.concatenate(x) if found else none for x in zip(*found, strict=True)) if found else (none, none)
    return start, depth


def runs(codes: np.ndarray, first: np.ndarray, least: int, repeats: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of at least `least` words and `repeats` periods, by start and period."""
    s = suffixes(codes, first)
    start, period = branching_tandems(s, shared_lengths(s))
    end = start + 2 * period
    need = np.maximum(least, repeats * period)
    row_start = first[np.searchsorted(first, start, "right") - 1] if len(start) else start

    def periodic(length: np.ndarray) -> np.ndarray:
        """Whether the `length` words up to end, all in the text, have the period."""
        i = end - length
        inside = i >= row_start
        i = np.where(inside, i, start)
        return inside & (s.agree(i, i + period) >= np.where(inside, length, 2 * period) - period)

    good = periodic(np.maximum(need, 2 * period))
    start, period, end, need, row_start = (x[good] for x in (start, period, end, need, row_start))
    # Rotate to the left: the longest stretch that keeps the period, by halving.
    low, high = np.maximum(need, 2 * period), end - row_start
    while (low < high).any():
        middle = (low + high + 1) // 2
        ok = periodic(middle)
        low, high = np.where(ok, middle, low), np.where(ok, high, middle - 1)
    begin = end - low
    by = np.lexsort((period, end, begin))
    begin, end, period = begin[by], end[by], period[by]
    once = np.ones(len(begin), bool)  # the shortest of the periods of a stretch
    once[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    begin, end, period = begin[once], end[once], period[once]
    by = np.lexsort((period, begin))
    return begin[by], (end - begin)[by], period[by]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray, first: np.ndarray) -> pa.Array:
    """The kept words of every row, joined by one space."""
    size = ends[kept] - starts[kept] + 1  # with the space behind
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    out = np.full(total, 0x20, np.uint8)
    from_ = np.repeat(starts[kept] - (stop - size), size) + np.arange(total)
    body = np.ones(total, bool)
    body[stop - 1] = False
    out[body] = data[from_[body]]
    bounds = np.concatenate([[0], stop])[np.searchsorted(kept, first)]
    raw = out.tobytes()
    return pa.array([raw[a : max(a, b - 1)] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()).cast(pa.string())


def periodic_runs(docs: DataFrame, least: int = 6, repeats: int = 4) -> DataFrame:
    """For each row doc_id, n_words, its runs by start and period, and the text without repetitions.

    collapsed: the words, joined by one space, but for those that a run holds behind its first period.
    """
    if least < 2 or repeats < 2:
        raise ValueError("a run is at least two words and two periods")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, STEP):
            w = words(batch.column("text"), lower=False)
            first = np.asarray(w.first, np.int64)
            begin, length, period = runs(np.asarray(w.codes, np.int64), first, least, repeats)
            change = np.zeros(len(w.codes) + 1, np.int64)
            np.add.at(change, begin + period, 1)
            np.add.at(change, begin + length, -1)
            kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            bounds = np.searchsorted(begin, first).astype(np.int32)
            own = begin - first[np.searchsorted(first, begin, "right") - 1]
            kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            found = pa.StructArray.from_arrays([pa.array(x) for x in (own, length, period)], fields=list(kind))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(first)),
                    pa.ListArray.from_arrays(pa.array(bounds), found),
                    _joined(w.data, w.starts, w.ends, kept, first),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")
