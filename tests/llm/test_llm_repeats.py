"""Periodic runs against a search of every period at every word, in Python."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

import cases
from llm import queries, repeats


def brute_runs(seq, least=6, times=4):
    """All maximal periodic stretches, the smallest period of each."""
    found = {}
    for q in range(1, len(seq) // times + 1):
        i = 0
        while i + q < len(seq):
            if seq[i] != seq[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(seq) and seq[j] == seq[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute(doc_id, text):
    seq = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(seq), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        seq = [seq[a + (i - a) % p] if i >= a else w for i, w in enumerate(seq)]
    found = brute_runs(seq)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(seq) if i not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *four, sha(lines), sha(kept))


def sequences():
    r = random.Random(5)
    out = [[], [1], [1] * 5, [1] * 6, [1] * 100, [1, 2] * 4, [1, 2] * 3 + [1], [1, 1, 1, 1, 1, 1, 2] * 5, [1, 2, 1, 2, 1, 2, 1, 2, 3] * 6]
    for letters in (1, 2, 3, 9):
        out += [[r.randrange(letters) for _ in range(r.randrange(120))] for _ in range(60)]
    for _ in range(60):  # periodic parts between others
        seq = []
        for _ in range(r.randrange(1, 5)):
            unit = [r.randrange(4) for _ in range(r.randrange(1, 9))]
            seq += unit * r.randrange(1, 9) + unit[: r.randrange(len(unit))] + [r.randrange(4) for _ in range(r.randrange(4))]
        out.append(seq)
    a, b = [0], [0, 1]
    for _ in range(9):
        a, b = b, b + a
    return [*out, b]


@pytest.mark.parametrize(("least", "times"), [(6, 4), (2, 2), (9, 3)])
def test_runs(least, times):
    seqs = sequences()
    first = np.cumsum([0, *map(len, seqs)])
    codes = np.array([c for s in seqs for c in s], np.int64)
    begin, length, period = repeats.runs(codes, first, least, times)
    want = [(int(first[k]) + a, n, q) for k, s in enumerate(seqs) for a, n, q in brute_runs(s, least, times)]
    assert list(zip(begin.tolist(), length.tolist(), period.tolist(), strict=True)) == sorted(want)
    assert want


def test_suffix_array():
    seqs = sequences()
    first = np.cumsum([0, *map(len, seqs)])
    codes = np.array([c for s in seqs for c in s], np.int64)
    s = repeats.suffixes(codes, first)
    tails = [(k, seqs[k][i:]) for k in range(len(seqs)) for i in range(len(seqs[k]))]
    assert [tails[i] for i in s.order.tolist()] == sorted(tails)
    assert (s.rank[s.order] == np.arange(len(tails))).all()
    lcp = repeats.shared_lengths(s).tolist()
    for t in range(1, len(tails), 7):
        (k, x), (m, y) = tails[s.order[t - 1]], tails[s.order[t]]
        same = 0
        while k == m and same < min(len(x), len(y)) and x[same] == y[same]:
            same += 1
        assert lcp[t] == same


def docs():
    out = cases.rows()
    for k, s in enumerate(sequences()):
        out.append((1000 + k, "\t ".join(f"w{c}é" for c in s) + "\n", None, None, None))
    out += [(5000 + k, cases.prose(k, 40), "en", None, None) for k in range(150)]
    return [d for d in out if len((d[1] or "").split()) < 5000]  # the brute search is quadratic


def test_query(spark, tmp_path):
    data = docs()
    cases.frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((brute(d[0], d[1]) for d in data), key=repr)
    assert sum(d[0] is not None and zlib.crc32(str(d[0]).encode()) % 10 == 0 for d in data) > 10


def test_operator_and_empty(spark):
    found = repeats.periodic_runs(cases.frame(spark, [(1, "a b a b a b a b c c c c c c d", None, None, None)])).collect()
    assert [tuple(r) for r in found[0].runs] == [(0, 8, 2), (8, 6, 1)] and found[0].collapsed == "a b c d"
    assert repeats.periodic_runs(cases.empty(spark)).collect() == []


@pytest.mark.parametrize("kind", ["one word", "long period", "halves", "prose"])
def test_long_texts(spark, kind):
    n = 150_000
    text = {
        "one word": "x " * n,
        "long period": (cases.prose(1, n // 5) + " ") * 5,
        "halves": ("a " * 300 + "b ") * (n // 300),
        "prose": cases.prose(2, n),
    }[kind]
    start = time.time()
    row = repeats.periodic_runs(cases.frame(spark, [(1, text, None, None, None)])).collect()[0]
    assert time.time() - start < 60
    if kind == "one word":
        assert [tuple(r) for r in row.runs] == [(0, n, 1)] and row.collapsed == "x"
    if kind == "long period":
        assert (0, n, n // 5) in [tuple(r) for r in row.runs]
    if kind == "halves":
        assert len(row.runs) == 1 + n // 300
