"""Best-fit packing of token sequences by hierarchical residual packing.

Documents become pieces of at most `capacity` tokens. Every task packs its own pieces best-fit, in order
of falling length. Bins that are full or nearly full are emitted; the others rise to the next level, each
as one item with its content, are dealt anew to fewer tasks and packed again. The tree ends when one task
is left, or when a round no longer lowers the number of bins noticeably: then every task still holds no more
than `per_task` items, so no task grows with the input.

Defined cases. A null or empty text has the end id alone and is one piece of length 1. Rows with the same
doc_id are packed like any others. Equal lengths are taken in order of doc_id, piece and checksum, so a
task that runs again gives the same bins. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import Scratch, partitions_for, steps
from llm.tokens import encoder

#: Bytes of text encoded at once: a token's worth of text needs some thirty times its size on the way.
STEP = 2 << 20
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ITEM = "sequence_id long, size int, pieces array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long>>"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, spaces: bool = True) -> DataFrame:
    """Each text's ids and the end id, cut from the end into pieces of `capacity`; the first may be shorter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, spaces)
        for batch in steps(batches, STEP):
            ids, bounds = enc.encode(batch.column("text"))
            # Every row's ids with the end id behind them, one row after the other.
            size = np.diff(bounds) + 1
            stop = np.cumsum(size)
            own = np.full(int(stop[-1]), end_id, "<u4")
            own[np.arange(len(ids)) + np.repeat(np.arange(len(size)), size - 1)] = ids
            pieces = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), pieces)
            number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = (size - 1) % capacity + 1
            upto = first[row] + number * capacity
            start = np.maximum(upto - capacity, 0)
            before = (stop - size)[row]
            data = memoryview(own).cast("B")
            edges = zip((4 * (before + start)).tolist(), (4 * (before + upto)).tolist(), strict=True)
            columns = [
                batch.column("doc_id").cast(pa.int64()).take(pa.array(row)),
                pa.array(number.astype(np.int32)),
                pa.array(start),
                pa.array(upto - start),
                pa.array([zlib.crc32(data[a:b]) for a, b in edges], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECE)


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The bin of every item, taken in the given order, by smallest sufficient room."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, bins, of = 0, 0, []  # open_rooms: bit r is set if some bin has room r
    for size in sizes:
        fits = open_rooms >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms &= ~(1 << r)
        else:
            r, b, bins = capacity, bins, bins + 1
        if r > size:
            room[r - size].append(b)
            open_rooms |= 1 << (r - size)
        of.append(b)
    return of


def _pack_level(items: DataFrame, capacity: int, level: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [(s, p) for b in batches for s, p in zip(b.column("size").to_pylist(), b.column("pieces").to_pylist(), strict=True)]
        if not table:
            return
        table.sort(key=lambda x: (-x[0], x[1][0]["doc_id"] or 0, x[1][0]["piece"], x[1][0]["start"], x[1][0]["ids_crc32"]))
        of = best_fit([s for s, _ in table], capacity)
        size, content = [0] * (max(of) + 1), [[] for _ in range(max(of) + 1)]
        for b, (s, p) in zip(of, table, strict=True):
            size[b] += s
            content[b] += p
        base = (level << 56) + (TaskContext.get().partitionId() << 32)
        schema = pa.schema([("sequence_id", pa.int64()), ("size", pa.int32()), ("pieces", _pieces_type())])
        for a in range(0, len(size), 5000):
            ids = [base + i for i in range(a, min(a + 5000, len(size)))]
            yield pa.RecordBatch.from_pydict(
                {"sequence_id": ids, "size": size[a : a + 5000], "pieces": content[a : a + 5000]}, schema=schema
            )

    return items.mapInArrow(pack, _ITEM)


def _pieces_type() -> pa.DataType:
    return pa.list_(
        pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    )


def pack(
    pieces: DataFrame,
    scratch: Scratch,
    capacity: int = 1024,
    slack: int = 8,
    per_task: int = 60_000,
    fan_in: int = 4,
    least_gain: float = 0.002,
) -> DataFrame:
    """Pieces with sequence_id and offset in the sequence.

    slack: bins with at most so much room are nearly full. per_task: items in a task, whatever the level.
    least_gain: the share of bins a round must save for another one.
    """
    pieces = scratch.table(pieces)
    whole = pieces.filter(F.col("length") >= capacity).select(
        *[c.split()[0] for c in PIECE.split(", ")],
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    piece = F.struct(*[F.col(c.split()[0]) for c in PIECE.split(", ")])
    items = pieces.filter(F.col("length") < capacity).select(
        F.col("length").cast("int").alias("size"), F.array(piece).alias("pieces")
    )
    done = []
    left = items.count()
    tasks = partitions_for(left, per_task // fan_in)
    level = 1
    while left:
        dealt = items.repartition(tasks, F.xxhash64("pieces"))
        bins = scratch.table(_pack_level(dealt, capacity, level))
        done.append(bins.filter(F.col("size") >= capacity - slack))
        rest = bins.filter(F.col("size") < capacity - slack)
        after = rest.count()
        gain = left - after - done[-1].count()
        fewer = max(1, tasks // fan_in, partitions_for(after, per_task))
        if tasks == 1 or fewer == tasks or (level > 1 and gain < least_gain * left):
            done.append(rest)
            break
        items, left, tasks, level = rest.select("size", "pieces"), after, fewer, level + 1
    out = whole
    for bins in done:
        ends = F.expr("transform(pieces, (p, i) -> struct(p, aggregate(slice(pieces, 1, i), 0L, (a, q) -> a + q.length) as offset))")
        out = out.unionByName(
            bins.select("sequence_id", F.explode(ends).alias("x")).select(
                "x.p.*", "sequence_id", "x.offset"
            )
        )
    return out
