"""The Jaccard join against all pairs, with the limits of one task and with tiny ones."""

from fractions import Fraction

import cases
import numpy as np
import pyarrow as pa
import pytest

from llm.common import Scratch
from llm.jaccard import candidate_forest, gram_sets, jaccard_components, needed, prefix, signature, true_forest


def roots(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def expected(docs):
    """(doc_id, size, smallest linked id) by comparing every pair of word tuples."""
    sets = []
    for d in docs:
        w = (d[1] or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    pairs = [
        (i, j)
        for i in range(len(docs))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    root = roots(len(docs), pairs)
    least = {}
    for d, r in zip(docs, root, strict=True):
        if d[0] is not None:
            least[r] = min(least.get(r, d[0]), d[0])
    return sorted(((d[0], len(s), least.get(r)) for d, s, r in zip(docs, sets, root, strict=True)), key=repr)


def cluster(seed, size, share):
    base = cases.prose(seed, 60)
    return [cases.edited(base, seed * 100 + i, share) for i in range(size)]


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 600, "family_bytes": 6000, "least_hot": 2}])
def test_components(spark, limits):
    docs = cases.rows()
    shared = cases.prose(77, 60)
    for k, text in enumerate(cluster(11, 40, 0.04) + cluster(12, 30, 0.02) + [cases.prose(50 + i, 80) + " " + shared for i in range(25)]):
        docs.append((1000 + k, text, "en", "s", 0))
    got = jaccard_components(cases.frame(spark, docs), Scratch(spark, "t"), **limits)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr)
    assert got == expected(docs)


def test_empty(spark):
    assert jaccard_components(cases.empty(spark), Scratch(spark, "t")).collect() == []


def test_prefixes_of_linked_sets_meet():
    t = Fraction(3, 4)
    r = np.random.default_rng(1)
    none = np.zeros(0, np.uint64)
    for _ in range(300):
        base = np.unique(r.integers(0, 1 << 62, r.integers(1, 60)).astype(np.uint64))
        other = np.unique(np.concatenate([base[r.random(len(base)) > 0.15], r.integers(0, 1 << 62, r.integers(0, 8)).astype(np.uint64)]))
        if len(other) and len(np.intersect1d(base, other)) >= needed(len(base), len(other), t):
            assert len(np.intersect1d(prefix(base, none, none, t), prefix(other, none, none, t)))


def test_tree_keeps_every_link():
    t = Fraction(3, 4)
    texts = [x for seed in range(20) for x in cluster(seed + 1, 12, 0.03)] + [cases.prose(900 + i, 10 + 7 * i) for i in range(60)]
    sets = gram_sets(pa.array(texts), 5)
    sizes = np.array([len(s) for s in sets])
    found = roots(len(sets), candidate_forest(sizes, [signature(s) for s in sets], t))
    true = [(i, j) for i in range(len(sets)) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) >= needed(sizes[i], sizes[j], t)]
    assert len(true) > 100
    assert all(found[i] == found[j] for i, j in true)
    assert roots(len(sets), true_forest(sets, t)) == roots(len(sets), true)
