"""Words of Arrow string columns as integer codes and hashes, without a Python object per word.

A word is a run of bytes that are neither space nor 0x09-0x0D. UTF-8 bytes of other characters are
never among those, so working on bytes is exact. Lower-casing concerns A-Z only.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def binary_array(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The pieces of data between consecutive cuts."""
    return pa.BinaryArray.from_buffers(
        pa.large_binary(),
        len(cuts) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(cuts, np.int64)), pa.py_buffer(data)],
    )


def bytes_list(values: pa.Array) -> list[bytes]:
    """A large binary column without nulls as a list, cut from its buffer: `to_pylist` makes a scalar of each value first."""
    if not len(values):
        return []
    _, offsets, data = values.buffers()
    off = np.frombuffer(offsets, np.int64, len(values) + 1, values.offset * 8)
    raw = data[off[0] : off[-1]].to_pybytes() if data is not None else b""
    return [raw[a:b] for a, b in pairwise((off - off[0]).tolist())]


@dataclass
class Words:
    """codes[i] numbers the i-th word; row r has the words first[r] to first[r + 1]."""

    codes: np.ndarray
    first: np.ndarray
    distinct: pa.Array
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        table = np.fromiter(
            map(xxhash.xxh3_64_intdigest, bytes_list(self.distinct)), np.uint64, len(self.distinct)
        )
        return table[self.codes]


def words(texts: pa.Array, lower: bool = True) -> Words:
    data, off = buffers(texts)
    data = np.ascontiguousarray(LOWER[data] if lower else data)
    n = len(data)
    blank = SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[1:n] = blank[1:] != blank[:-1]
    cut[off] = True
    cut[0] = cut[n] = True
    cuts = np.flatnonzero(cut)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return Words(empty, np.zeros(len(off), np.int64), pa.array([], pa.large_binary()), empty, empty, data, off)
    is_word = ~blank[cuts[:-1]]
    starts, ends = cuts[:-1][is_word], cuts[1:][is_word]
    coded = binary_array(data, cuts).filter(pa.array(is_word)).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return Words(codes, np.searchsorted(starts, off), coded.dictionary, starts, ends, data, off)


def mix(h: np.ndarray) -> np.ndarray:
    """Finisher that spreads every bit of a 64-bit value."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the words i to i + width - 1 at every i; the last width - 1 values mean nothing."""
    total = hashes.copy()
    for k in range(1, width):
        total *= _MULTIPLIER
        total[: len(hashes) - k] += hashes[k:]
    return mix(total + np.uint64(width))


def short_hash(hashes: np.ndarray) -> np.uint64:
    """Hash of one whole sequence of words."""
    with np.errstate(over="ignore"):
        total = np.uint64(0)
        for h in hashes:
            total = total * _MULTIPLIER + h
        return mix(np.array([total + np.uint64(len(hashes))]))[0]


def code_points(data: np.ndarray) -> np.ndarray:
    """Number of characters before every byte, one value more than bytes."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
