"""Benchmark decontamination: n-gram seeds find passages, Smith-Waterman alignment scores them.

Words are runs without white space, A-Z lower-cased. Every n-gram of an item is a seed, however many documents
it occurs in: an edited copy shares only some n-grams with its item, and which ones, or how often the copy is
repeated, doesn't say that they prove nothing. One pass joins the seeds with the texts. Around every hit, the
passage that could hold the item is aligned with it word by word (match 2, mismatch -1, gap -1); the score is
divided by the score of an exact copy. Passages that share too few words to reach the threshold are not aligned.
A passage without any n-gram of the item in common isn't found.

The test items go to every task in blocks of at most `block_bytes` of text; larger test sets take several
turns over the texts, so no broadcast grows with either side.

Defined cases. Null and empty texts and items without a word match nothing. Items with fewer words than
`width` have one seed, the whole item. Items with equal texts each match. A repeated row gives repeated
results. Empty tables on either side give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import steps
from llm.text import code_points, gram_hashes, words

MATCH, MISMATCH, GAP = 2, -1, -1
#: Bytes of text compared at once: a common n-gram makes many hits, so a step takes many times its size.
STEP = 1 << 20
LEAK = "doc_id long, item_id long, score double, n_seeds int, start_char long, end_char long"
_TABLE_BITS = 22


class Items:
    """A block of test items: word hashes, and the n-grams by hash with the places they come from."""

    def __init__(self, ids: list[int], texts: list[str | None], width: int):
        found = words(pa.array(texts, pa.string()))
        hashes = found.hashes()
        self.ids = ids
        self.words = [hashes[a:b] for a, b in zip(found.first, found.first[1:], strict=False)]
        grams, item, at, size = [], [], [], []
        for k, own in enumerate(self.words):
            w = min(width, len(own))
            if w:
                g = gram_hashes(own, w)[: len(own) - w + 1]
                grams.append(g)
                item += [k] * len(g)
                at += range(len(g))
                size += [w] * len(g)
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.item, self.at = np.array(item, np.int64)[order], np.array(at, np.int64)[order]
        self.gram, self.first = np.unique(flat[order], return_index=True)
        self.first = np.append(self.first, len(flat))
        self.widths = sorted(set(size))

    def table(self) -> np.ndarray:
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[(self.gram >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
        return table


def _hits(items: Items, table: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, word positions and gram numbers of all n-grams in the texts that are among the items'."""
    rows, places, grams = [], [], []
    for w in items.widths:
        if len(hashes) < w:
            continue
        g = gram_hashes(hashes, w)[: len(hashes) - w + 1]
        at = np.flatnonzero(table[(g >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        k = np.searchsorted(items.gram, g[at])
        ok = k < len(items.gram)
        at, k = at[ok], k[ok]
        ok = items.gram[k] == g[at]
        at, k = at[ok], k[ok]
        row = np.searchsorted(first, at, "right") - 1
        ok = at + w <= first[row + 1]
        rows.append(row[ok])
        places.append(at[ok])
        grams.append(k[ok])
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(rows), join(places), join(grams)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local score, and one past the passage's last word in that alignment."""
    n = len(passage)
    steps_ = np.arange(n + 1) * -GAP
    row, best, end = np.zeros(n + 1, np.int64), 0, 0
    for word in item:
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(passage == word, MATCH, MISMATCH))
        row = np.maximum.accumulate(new + steps_) - steps_
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


def _passages(places: np.ndarray, at: np.ndarray, length: int, low: int, high: int) -> list[tuple[int, int, int]]:
    """Windows in which the item could lie around its hits, merged where they overlap, and their hits."""
    pad = length // 2 + 1
    begin = np.maximum(places - at - pad, low)
    end = np.minimum(places - at + length + pad, high)
    out: list[list[int]] = []
    for a, b in sorted(zip(begin.tolist(), end.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
            out[-1][2] += 1
        else:
            out.append([a, b, 1])
    return [tuple(x) for x in out]


def leaks_in_block(docs: DataFrame, items: Items, threshold: float) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = items.table()
        bags = [np.unique(w, return_counts=True) for w in items.words]
        known: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        for batch in steps(batches, STEP):
            found = words(batch.column("text"))
            hashes = found.hashes()
            row, place, gram = _hits(items, table, hashes, found.first)
            if not len(row):
                continue
            n = np.diff(items.first)[gram]
            pick = np.repeat(items.first[gram] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            row, place, item, at = np.repeat(row, n), np.repeat(place, n), items.item[pick], items.at[pick]
            order = np.lexsort((place, item, row))
            row, place, item, at = row[order], place[order], item[order], at[order]
            edge = np.flatnonzero(np.diff(row * len(items.ids) + item, prepend=-1))
            out = []
            chars = None
            for a, b in zip(edge, np.append(edge[1:], len(row)), strict=True):
                r, k = int(row[a]), int(item[a])
                own, (kinds, counts) = items.words[k], bags[k]
                most = MATCH * len(own)
                best = None
                for low, high, seeds in _passages(place[a:b], at[a:b], len(own), int(found.first[r]), int(found.first[r + 1])):
                    passage = hashes[low:high]
                    where = np.minimum(np.searchsorted(kinds, passage), len(kinds) - 1)
                    shared = np.bincount(where[kinds[where] == passage], minlength=len(kinds))
                    if MATCH * np.minimum(shared, counts).sum() < threshold * most:
                        continue
                    key = (k, passage.tobytes())
                    if key not in known:
                        score, end = align(own, passage)
                        _, back = align(own[::-1], passage[:end][::-1]) if score >= threshold * most else (0, 0)
                        if len(known) > 20_000:
                            known.clear()
                        known[key] = score, end - back, end
                    score, begin, end = known[key]
                    if score >= threshold * most and (best is None or score > best[0]):
                        best = score, low + begin, low + end, seeds
                if best:
                    chars = code_points(found.data) if chars is None else chars
                    base = chars[found.offsets[r]]
                    out.append((batch.column("doc_id")[r].as_py(), items.ids[k], best[0] / most, best[3], int(chars[found.starts[best[1]]] - base), int(chars[found.ends[best[2] - 1]] - base)))
            if out:
                kinds_ = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64())
                names = [c.split()[0] for c in LEAK.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds_, strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(find, LEAK)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 3,
    threshold: float = 0.5,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """doc_id, item_id, score, n_seeds and the best passage's place, for each document with part of an item."""
    spark = docs.sparkSession
    tests = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("text").isNotNull())
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = spark.createDataFrame([], LEAK)
    for block in range(blocks):
        own = tests.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        if own:
            items = Items([r["item_id"] for r in own], [r["text"] for r in own], width)
            if len(items.gram):
                out = out.unionByName(leaks_in_block(docs, items, threshold))
    return out
