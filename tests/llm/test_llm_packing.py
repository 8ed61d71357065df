"""Packing: every token once, no sequence over the limit, few sequences, defined for odd rows."""

import zlib
from collections import Counter

import cases
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.common import Scratch
from llm.packing import best_fit, pack, token_pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(docs, capacity):
    tok = Tokenizer.from_file(PATH)
    out = []
    for d in docs:
        ids = [*tok.encode(d[1] or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % capacity + 1
        edges = [0, *range(first, len(ids) + 1, capacity)]
        out += [(d[0], i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    return out


@pytest.mark.parametrize("per_task", [60_000, 16])
def test_pack(spark, per_task):
    docs = cases.rows()
    r = pack(token_pieces(cases.frame(spark, docs), PATH, 64, 2), Scratch(spark, "t"), 64, slack=2, per_task=per_task).collect()
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in r) == Counter(expected(docs, 64))
    sequences = {}
    for x in r:
        sequences.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(x.length for x in r)
    assert len(sequences) <= 1.05 * total / 64 + 2


def test_empty(spark):
    assert pack(token_pieces(cases.empty(spark), PATH, 64, 2), Scratch(spark, "t"), 64).collect() == []


def test_best_fit_is_the_smallest_room():
    r = np.random.default_rng(3)
    sizes = sorted(r.integers(1, 100, 500).tolist(), reverse=True)
    room, want = [], []
    for s in sizes:
        fits = [k for k in range(len(room)) if room[k] >= s]
        if fits:
            k = min(fits, key=lambda k: room[k])
        else:
            room.append(100)
            k = len(room) - 1
        room[k] -= s
        want.append(room[k])
    of, left, got = best_fit(sizes, 100), {}, []
    for s, b in zip(sizes, of):
        left[b] = left.get(b, 100) - s
        got.append(left[b])
    assert got == want
