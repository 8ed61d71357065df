"""Quality rules: fixed measures, and a hashed n-gram log-likelihood ratio of trusted text against the corpus.

Byte n-grams of every text are hashed into 2^bits buckets. One pass counts the buckets over all documents, the
raw multinomial, and over the trusted ones, the target multinomial. A text's score is the sum of
log(target / raw) over its n-grams, divided by their number plus `shrink`, so that a handful of n-grams
proves little. A text is kept if the score is at least a limit: the decision is the same for the same text,
nothing is sampled.

The limit comes from labels. A third of the trusted ids, by hash, stays out of the target, so that their scores are
those of texts the target has not seen. Untrusted rows come with a reason (low quality, toxic, ...). Among the texts
that pass the base measures, the limit is the multiple of 1 / `LEVELS` with the largest sum of the share of held-out
trusted texts kept and the share of untrusted ones rejected, the latter averaged over reasons, so that a rare
reason counts as much as a common one; of equal ones the lowest. Without an untrusted table, or if either side has no
text left, the limit is `least`, and without an untrusted table all trusted ids make the target.

Base measures, over words (runs without white space) and lines (split at \\n): see `measures`. A text fails
them with fewer than 10 words or with more than a fifth of its words in repeated 5-word windows.

Defined cases. A null text is empty; it has no words and fails. A text shorter than an n-gram scores 0.
Without any trusted text all scores are 0. Repeated rows count repeatedly and give repeated results. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import crc_mod, steps
from llm.text import binary_array, buffers, code_points, gram_hashes, mix, words

BITS, GRAM, SHRINK, LEAST = 18, 4, 32, -0.9
LEVELS = 1000
WINDOW = 5
#: Trusted ids that are sent to every task; more than that are joined by a shuffle.
MOST_SENT = 1_000_000
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True  # Fixed values


def buckets(data: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of the n-gram that begins at each byte; texts are apart only by the offsets."""
    if len(data) < GRAM:
        return np.zeros(0, np.uint32)
    x = data.astype(np.uint32)
    n = len(x) - GRAM + 1
    gram = x[:n] | (x[1 : n + 1] << 8) | (x[2 : n + 2] << 16) | (x[3 : n + 3] << 24)
    return (gram * np.uint32(2654435761)) >> np.uint32(32 - bits)


def _gram_ends(off: np.ndarray) -> np.ndarray:
    return np.maximum(off[1:] - GRAM + 1, off[:-1])


def bucket_counts(docs: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Raw and target counts over all documents (columns text, trusted), 2^bits numbers each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << bits), np.int64)
        for batch in steps(batches):
            data, off = buffers(batch.column("text"))
            own = buckets(data, bits)
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            n = _gram_ends(off) - off[:-1]
            kind = np.zeros(len(data) + 1, np.int8)  # 0: across texts, 1: other, 2: trusted
            at = np.repeat(off[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            kind[at] = np.repeat(1 + trusted, n)
            kind = kind[: len(own)]
            total[0] += np.bincount(own[kind > 0], minlength=1 << bits)
            total[1] += np.bincount(own[kind > 1], minlength=1 << bits)
        seen = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(total[0][seen]), pa.array(total[1][seen])], ["bucket", "n", "trusted"]
        )

    out = np.zeros((2, 1 << bits), np.int64)
    counted = docs.mapInArrow(count, "bucket long, n long, trusted long").groupBy("bucket")
    for bucket, n, trusted in counted.agg(F.sum("n"), F.sum("trusted")).collect():
        out[:, bucket] = n, trusted
    return out[0], out[1]


def log_ratios(raw: np.ndarray, target: np.ndarray, prior: float = 10_000.0, most: float = 6.0) -> np.ndarray:
    """log(target / raw) of each bucket; the target leans on the raw counts with the weight of `prior` n-grams."""
    if not raw.sum() or not target.sum():
        return np.zeros(len(raw))
    p_raw = raw / raw.sum()
    p_target = (target + prior * p_raw) / (target.sum() + prior)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.log(p_target) - np.log(p_raw)
    return np.clip(np.where(raw > 0, ratio, 0.0), -most, most)


def with_trusted(docs: DataFrame, trusted: DataFrame, most_sent: int = MOST_SENT) -> DataFrame:
    """text and whether the doc_id is among the trusted ones, of all documents."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("trusted_id")).filter("trusted_id IS NOT NULL").distinct()
    if ids.count() <= most_sent:
        ids = F.broadcast(ids)
    joined = docs.select(F.col("doc_id").cast("long"), "text").join(ids, F.col("doc_id") == F.col("trusted_id"), "left")
    return joined.select("text", F.col("trusted_id").isNotNull().alias("trusted"))


def best_limit(found: DataFrame, held: DataFrame, untrusted: DataFrame, least: float) -> float:
    """The limit for scores (doc_id, base_failed, score) that tells held-out trusted ids from untrusted ones best."""
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    wrong = untrusted.select(doc_id, F.col("reason").cast("string")).filter("doc_id IS NOT NULL AND reason IS NOT NULL").distinct()
    right = held.select(doc_id).distinct().join(wrong.select("doc_id"), "doc_id", "left_anti")
    labels = wrong.unionByName(right.withColumn("reason", F.lit(None).cast("string")))
    level = F.floor(F.col("score") * LEVELS).cast("int").alias("level")
    # The scores reach from -6 to 6, so these are a few thousand numbers a reason, whatever the number of rows.
    counted = found.filter("NOT base_failed").join(labels, "doc_id").groupBy("reason", level).count().collect()
    if not any(r["reason"] is None for r in counted) or not any(r["reason"] is not None for r in counted):
        return least
    low, high = min(r["level"] for r in counted), max(r["level"] for r in counted) + 1
    below = {r["reason"]: np.zeros(high - low + 1) for r in counted}
    for reason, at, n in counted:
        below[reason][at - low + 1] = n
    share = {k: np.cumsum(v) / v.sum() for k, v in below.items()}
    gain = np.mean([v for k, v in share.items() if k is not None], axis=0) - share[None]
    return (low + int(np.argmax(np.round(gain, 12)))) / LEVELS


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    bits: int = BITS,
    shrink: int = SHRINK,
    least: float = LEAST,
    untrusted: DataFrame | None = None,
) -> DataFrame:
    """The measures, base_failed, score and kept for every document. trusted: the doc_ids of the target.

    untrusted (doc_id, reason): the labelled rows that the limit must tell from the trusted ones.
    """
    if untrusted is None:
        ratios = log_ratios(*bucket_counts(with_trusted(docs, trusted), bits)).astype(np.float32)
        return rated(docs, ratios, bits, shrink, least)
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    ratios = log_ratios(*bucket_counts(with_trusted(docs, trusted.filter(~held)), bits)).astype(np.float32)
    limit = best_limit(rated(docs, ratios, bits, shrink, least), trusted.filter(held), untrusted, least)
    return rated(docs, ratios, bits, shrink, limit)


def rated(docs: DataFrame, ratios: np.ndarray, bits: int, shrink: int, least: float) -> DataFrame:
    """The measures, base_failed, score and kept for every document, by the log ratios of the buckets."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = measures(batch.column("text"))
            data, off = buffers(batch.column("text"))
            # Whole steps of a fixed-point sum, so that a text's score doesn't depend on its neighbours.
            value = np.rint(ratios[buckets(data, bits)].astype(np.float64) * (1 << 20)).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(value), np.zeros(GRAM, np.int64)])
            ends = _gram_ends(off)
            live = ends > off[:-1]
            score = np.where(live, total[ends] - total[off[:-1]], 0) / (1 << 20) / (ends - off[:-1] + shrink)
            failed = (found["n_words"] < 10) | (100 * found["n_repeat_words"] > 20 * found["n_words"])
            columns = [batch.column("doc_id"), *(pa.array(v.astype(np.int64)) for v in found.values())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(failed), pa.array(~failed & (score >= least)), pa.array(score)],
                ["doc_id", *found, "base_failed", "kept", "score"],
            )

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(make, schema)


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars (code points in words), n_symbols, n_dup_lines, n_repeat_words of every text."""
    found = words(texts, lower=False)
    data, off, first = found.data, found.offsets, found.first
    rows = len(off) - 1
    sums = lambda values, at: np.concatenate([[0], np.cumsum(values)])[at]
    chars = code_points(data)
    per_word = sums(chars[found.ends] - chars[found.starts], first)
    symbols = sums(_SYMBOLS[data], off)

    cut = np.zeros(len(data) + 1, bool)
    newline = np.flatnonzero(data == 0x0A)
    cut[newline] = cut[newline + 1] = True  # the newline is a piece of its own, without a word
    cut[off] = True
    cut[0] = cut[-1] = True
    cuts = np.flatnonzero(cut)
    dup_lines = np.zeros(rows, np.int64)
    if len(data):
        in_words = np.searchsorted(found.starts, cuts)
        has_word = in_words[1:] > in_words[:-1]
        codes = binary_array(data, cuts).dictionary_encode().indices.to_numpy(zero_copy_only=False)[has_word]
        row = (np.searchsorted(off, cuts[:-1], "right") - 1)[has_word]
        lines = np.bincount(row, minlength=rows)
        distinct = np.unique(row.astype(np.int64) << 32 | codes)
        dup_lines = lines - np.bincount(distinct >> 32, minlength=rows)

    repeat_words = np.zeros(rows, np.int64)
    n = len(found.codes)
    if n >= WINDOW:
        row = np.repeat(np.arange(rows), np.diff(first))
        grams = gram_hashes(found.hashes(), WINDOW)[: n - WINDOW + 1]
        inside = row[: n - WINDOW + 1] == row[WINDOW - 1 :]
        at = np.flatnonzero(inside)
        key = mix(grams[at] ^ mix(row[at].astype(np.uint64) + np.uint64(1)))
        _, which, counts = np.unique(key, return_inverse=True, return_counts=True)
        twice = at[counts[which] > 1]
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, twice, 1)
        np.add.at(change, twice + WINDOW, -1)
        repeat_words = np.diff(sums(np.cumsum(change)[:n] > 0, first))
    return {
        "n_words": np.diff(first),
        "word_chars": np.diff(per_word),
        "n_symbols": np.diff(symbols),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat_words,
    }
