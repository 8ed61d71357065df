"""Token ids as canonical, length-limited Huffman codes, in files of independent blocks.

Texts are encoded once into a table of ids, whose global counts, one number for each id of the vocabulary,
give the code: package-merge finds the optimal lengths of at most `longest` bits, and codes are canonical, so
the lengths are all that is stored. The table is then dealt by ranges of doc_id, sorted, and written in
blocks of about `block_ids` ids.

Files. `codes` is Parquet with id and length. `blocks` is Parquet with part and block, which give the order,
docs, n_ids, doc_ids and counts (little-endian 64-bit integers, one for each document), checkpoints
(little-endian unsigned 32-bit bit offsets of every `every`-th id) and bits. A block is decoded by a
table over `longest` bits, from all its checkpoints at once, without any other block.

Defined cases. A null or empty text has the end id alone. Rows with the same doc_id are separate documents,
ordered by number of ids and checksum, equal rows one after another. A null doc_id comes first. An empty
table gives no blocks. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import Scratch, partitions_for, steps
from llm.text import buffers
from llm.tokens import encoder

LONGEST, EVERY, BLOCK_IDS = 16, 128, 1 << 18
COUNTED = 1 << 20  # ids that are counted at once
_NO_ID = np.iinfo(np.int64).min
_BLOCK = "part int, block int, docs long, n_ids long, doc_ids binary, counts binary, checkpoints binary, bits binary"


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most `longest` bits by package-merge; 0 for what doesn't occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError("too many symbols for this length")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    is_leaf = []
    packages = np.zeros(0, np.int64)
    for _ in range(longest):
        items = np.concatenate([weights, packages])
        leaf = np.arange(len(items)) < len(weights)
        by = np.argsort(items, kind="stable")
        items, leaf = items[by], leaf[by]
        is_leaf.append(leaf)
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
    taken = 2 * len(weights) - 2
    depth = np.zeros(len(weights), np.int64)
    for leaf in reversed(is_leaf):
        leaves = int(leaf[:taken].sum())
        depth[:leaves] += 1
        taken = 2 * (taken - leaves)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    code, last = 0, 0
    order = used[np.lexsort((used, lengths[used]))]
    for length in np.unique(lengths[order]).tolist():
        same = order[lengths[order] == length]
        code <<= length - last
        codes[same] = code + np.arange(len(same))
        code, last = code + len(same), length
    return codes


def decoding_table(lengths: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """For all values of the next `longest` bits, the id and how many bits it takes."""
    ids, width = np.zeros(1 << longest, np.uint32), np.zeros(1 << longest, np.uint8)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        spans = 1 << (longest - lengths[order].astype(np.int64))
        filled = int(spans.sum())
        ids[:filled], width[:filled] = np.repeat(order, spans), np.repeat(lengths[order], spans)
    return ids, width


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, every: int = EVERY) -> tuple[np.ndarray, bytes]:
    """Checkpoints, and the codes of all ids one after another."""
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    at = ends - n
    total = int(ends[-1]) if len(ends) else 0
    placed = codes[ids].astype(np.int64) << (24 - (at & 7) - n)
    size = (total + 7) // 8 + 3
    out = np.zeros(size)
    for k in range(3):  # a code of up to 16 bits touches up to three bytes, and no two share a bit
        out += np.bincount((at >> 3) + k, (placed >> (16 - 8 * k)) & 0xFF, size)
    return at[::every].astype("<u4"), out.astype(np.uint8)[: (total + 7) // 8].tobytes()


def decode_block(bits: bytes, checkpoints: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray], every: int = EVERY) -> np.ndarray:
    ids, width = table
    data = np.frombuffer(bits + b"\0\0\0", np.uint8).astype(np.uint32)
    windows = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    at = checkpoints.astype(np.int64)
    out = np.zeros((every, len(at)), np.uint32)
    last = len(windows) - 1
    for k in range(every):
        seen = (windows[np.minimum(at >> 3, last)] >> (8 - (at & 7)).astype(np.uint32)) & 0xFFFF
        out[k] = ids[seen]
        at += width[seen]
    return out.T.ravel()[:n]


def id_table(docs: DataFrame, tokenizer: str, end_id: int, spaces: bool) -> DataFrame:
    """doc_id, n_ids, checksum and the ids of each text and the end id, as unsigned 16-bit integers."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, spaces)
        for batch in steps(batches):
            ids, bounds = enc.encode(batch.column("text"))
            if len(ids) and ids.max() > 0xFFFF:
                raise ValueError("ids of more than 16 bits")
            ids = ids.astype("<u2")
            end = np.array([end_id], "<u2").tobytes()
            own = [ids[a:b].tobytes() + end for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) // 2 for x in own], pa.int64()),
                    pa.array([zlib.crc32(x) for x in own], pa.int64()),
                    pa.array(own, pa.binary()),
                ],
                ["doc_id", "n_ids", "checksum", "ids"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(make, "doc_id long, n_ids long, checksum long, ids binary")


def id_counts(ids: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents, one number for each of 65,536 ids at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            ids = buffers(batch.column("ids"))[0].view("<u2")
            for i in range(0, len(ids), COUNTED):
                total += np.bincount(ids[i : i + COUNTED], minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counts = np.zeros(1 << 16, np.int64)
    for i, n in ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n")).collect():
        counts[i] = n
    return counts


def write_blocks(ids: DataFrame, lengths: np.ndarray, rows: int, block_ids: int = BLOCK_IDS, docs_per_task: int = 20_000) -> DataFrame:
    codes = canonical_codes(lengths)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        doc_ids, counts, held, n = [], [], [], 0

        def closed() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(held), "<u2")
            checkpoints, bits = encode_block(flat, codes, lengths)
            row = (part, block, len(doc_ids), n, np.array(doc_ids, "<i8").tobytes(), np.array(counts, "<i8").tobytes(), checkpoints.tobytes(), bits)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4)
            names = [c.split()[0] for c in _BLOCK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for doc_id, count, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_ids", "ids")), strict=True):
                doc_ids.append(_NO_ID if doc_id is None else doc_id)
                counts.append(count)
                held.append(own)
                n += count
                if n >= block_ids:
                    yield closed()
                    doc_ids, counts, held, n, block = [], [], [], 0, block + 1
        if doc_ids:
            yield closed()

    ranged = ids.repartitionByRange(partitions_for(rows, docs_per_task), "doc_id", "n_ids", "checksum")
    return ranged.sortWithinPartitions("doc_id", "n_ids", "checksum").mapInArrow(make, _BLOCK)


def read_blocks(blocks: DataFrame, codes: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the blocks."""
    lengths = np.zeros(1 << 16, np.uint8)
    for i, n in codes.collect():  # the vocabulary's size at most
        lengths[i] = n
    table = decoding_table(lengths)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_block(row["bits"], np.frombuffer(row["checkpoints"], "<u4"), row["n_ids"], table).astype("<u4")
                counts = np.frombuffer(row["counts"], "<i8")
                ends = np.cumsum(counts)
                doc_ids = [None if d == _NO_ID else d for d in np.frombuffer(row["doc_ids"], "<i8").tolist()]
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(counts), pa.int32()),
                        pa.array([row["block"]] * len(counts), pa.int32()),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(ends - counts),
                        pa.array(counts),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "block", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    # One total for each part, and a running sum of the blocks within each part.
    part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    starts = blocks.select("part", "block", F.coalesce(F.sum("n_ids").over(part), F.lit(0)).alias("within"))
    starts = starts.join(totals, "part").select("part", "block", (F.col("within") + F.col("before")).alias("start"))
    schema = "part int, block int, doc_id long, at long, n_tokens long, ids_crc32 long"
    decoded = blocks.select("part", "block", "n_ids", "doc_ids", "counts", "checkpoints", "bits").mapInArrow(make, schema)
    return decoded.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("at") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


def write_token_files(docs: DataFrame, scratch: Scratch, tokenizer: str, end_id: int, spaces: bool) -> tuple[DataFrame, DataFrame]:
    """Write the files; the blocks and the codes as read from them."""
    ids = scratch.table(id_table(docs, tokenizer, end_id, spaces), codec="zstd")
    lengths = code_lengths(id_counts(ids))
    used = np.flatnonzero(lengths)
    rows = list(zip(used.tolist(), lengths[used].tolist(), strict=True))
    codes = scratch.table(docs.sparkSession.createDataFrame(rows, "id int, length int"))
    blocks = scratch.table(write_blocks(ids, lengths, ids.count()), codec="uncompressed")
    return blocks, codes
