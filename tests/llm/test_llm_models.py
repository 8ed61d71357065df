"""Language identification and language-model scoring: held-out quality, exact counts, normalisation."""

import collections
import random
import zlib

import cases
import numpy as np
import pyarrow as pa
import pytest

from llm import langid, lm
from llm.common import Scratch

SYLLABLES = {"en": "th er on an re he in ed nd ha at".split(), "fr": "eau ou é oi ai eux què la en".split(), "de": "sch ei ung ber ä pf zu ch".split()}


def text(lang, seed, n=60):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def docs():
    return [(i, text(lang, i), lang, "s", 0) for i, lang in enumerate(["en", "fr", "de"] * 60)]


def test_languages(spark, docs):
    model = langid.train(cases.frame(spark, docs[:120]), per_language=30)
    test = docs[120:] + cases.rows()
    got = langid.predict(cases.frame(spark, test).drop("lang_pred", "score"), model).collect()
    assert len(got) == len(test)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id >= 120}
    right = sum(by_id[d[0]].lang_pred == d[2] for d in docs[120:])
    assert right >= 58
    for r in got:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert (model.weights == 0).mean() > 0.5


def test_no_training_rows(spark, docs):
    assert langid.train(cases.empty(spark)) is None
    assert langid.train(cases.frame(spark, [(1, None, "en", None, None), (2, "1 2", "en", None, None)])) is None
    got = langid.predict(cases.frame(spark, docs[:3], extra=False), None).collect()
    assert {r.lang_pred for r in got} == {"und"}
    model = langid.train(cases.frame(spark, docs[:30]), per_language=5)
    assert langid.predict(cases.empty(spark).drop("lang_pred", "score"), model).collect() == []


def test_lm_counts_and_gain(spark, docs):
    rows = docs + cases.rows()
    got = lm.score(cases.frame(spark, rows), Scratch(spark, "t"), classes=64, sent=40).collect()
    assert len(got) == len(rows)
    words = [(d[1] or "").encode().lower().split() for d in rows]
    held = [d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 1 for d in rows]
    c, ends = collections.Counter(), held.count(False)
    for w, h in zip(words, held, strict=True):
        if not h:
            c.update(w)
    total, distinct = sum(c.values()) + ends, len(c) + 1
    norm = total + 0.5 * (distinct + 1)
    want = collections.Counter()
    for d, w, h in zip(rows, words, held, strict=True):
        base = sum(np.log10((c[x] + 0.5) / norm) for x in w) + np.log10((ends + 0.5) / norm)
        want[(d[0], h, len(w) + 1, sum(c[x] > 0 for x in w) + 1, total, round(base, 4))] += 1
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_model_is_normalised():
    r = np.random.default_rng(2)
    noise = r.random(50)
    model = lm.LogBilinear(noise / noise.sum(), 8)
    target = r.integers(0, 50, 5000)
    before = np.concatenate([[2], target[:-1]])
    model.train(target, before, np.roll(before, 1), r, 0.1)
    every = np.arange(50)
    for a, b in [(2, 2), (7, 9), (0, 1)]:
        p = 10 ** model.log10(every, np.full(50, a), np.full(50, b))
        assert p.sum() == pytest.approx(1, abs=1e-5)


def test_two_levels_equal_the_plain_softmax():
    """Group times class, token by token in plain numbers; the last group is not full, and 53 is a text's start."""
    r = np.random.default_rng(5)
    model = lm.LogBilinear(r.random(53), 6)
    target, before, second = (r.integers(0, n, 400) for n in (53, 54, 54))
    model.train(target, before, second, r, 0.2, batch=64)
    got = model.log10(target, before, second)
    for i in range(400):
        q = model.context[before[i]] * model.position[0] + model.context[second[i]] * model.position[1]
        by_group = np.exp(model.groups.vectors @ q + model.groups.bias)
        g = max(k for k in range(len(by_group)) if 2 * k * k <= target[i])
        own = np.exp(model.words.vectors @ q + model.words.bias)
        want = np.log10(by_group[g] / by_group.sum() * own[target[i]] / own[2 * g * g : 2 * (g + 1) ** 2].sum())
        assert got[i] == pytest.approx(want, abs=1e-4)


def test_lm_classes_grow_and_words_share(spark):
    """More tokens, more classes; all words, the unknown by their endings, and the end have probability 1 after any context."""
    assert [lm.classes_for(n) for n in (0, 10**5, 10**6, 10**8, 10**12)] == [1024, 2528, 8000, 80000, 1 << 18]
    words = {f"w{i}{'abcde'[i % 5]}": 1 + i * i for i in range(35)}
    counts = spark.createDataFrame([(w.encode(), n) for w, n in words.items()], "word binary, n long")
    vocab = lm.vocabulary(counts, 9, 14, 8)
    assert vocab.class_counts.sum() == vocab.total == sum(words.values()) + 9 and vocab.distinct == 36
    own = {w for w, i in vocab.rank.items() if vocab.cls[i] >= 0}
    assert len(own) == 8 and vocab.cls[-1] == -1 and sorted(vocab.class_counts, reverse=True) == list(vocab.class_counts)
    share = collections.Counter()
    for w, n in words.items():
        if w.encode() not in own:
            share[lm.ending(w.encode(), 2)] += n + 0.5
    for e in range(2):
        assert share[e] + 0.5 == vocab.rare_norm[e]
    found = counts.select("word", lm.ending_of("word", 4).alias("e")).collect()
    assert all(r.e == lm.ending(bytes(r.word), 4) for r in found)
    odd = spark.createDataFrame([(x,) for x in (b"a", b"ab", b"abc", "\u00e9".encode())], "word binary")
    assert [r[0] for r in odd.select(lm.ending_of("word", 64)).collect()] == [lm.ending(x, 64) for x in (b"a", b"ab", b"abc", "\u00e9".encode())]


def test_sums_by_place():
    """One row at most places, many at others; even and odd numbers of columns."""
    r = np.random.default_rng(4)
    for width in (5, 6):
        for place in (np.arange(7)[::-1], np.r_[np.arange(30), r.integers(0, 9, 400)], np.zeros(3, int)):
            rows = r.normal(size=(len(place), width)).astype(np.float32)
            want = np.zeros((place.max() + 1, width))
            np.add.at(want, place, rows)
            assert lm.sums_by(place, rows, len(want)) == pytest.approx(want, abs=1e-4)


def test_contrast_of_both_levels():
    """Gradients of the log likelihood of telling real from drawn ones, in plain numbers, more tokens than a part holds."""
    r = np.random.default_rng(6)
    model = lm.LogBilinear(r.random(53), 6)
    n, k, levels = lm.PART + 30, 5, []
    q = np.column_stack([r.normal(size=(n, 6)), np.ones(n)]).astype(np.float32)
    for level in (model.words, model.groups):
        level.rows[:] += r.normal(size=level.rows.shape)
        levels.append((level, r.integers(0, len(level.rows), n), level.draw(r, k)))
    g_q, found = lm.contrast(q, levels)
    want_q = np.zeros((n, 6))
    for (level, t, drawn), rows in zip(levels, found, strict=True):
        odds = q.astype(float) @ level.rows.T - level.log_noise - np.log(k)
        real = 1 / (1 + np.exp(-odds))
        own, others = 1 - real[np.arange(n), t], real[:, drawn]
        want_q += own[:, None] * level.vectors[t] - others @ level.vectors[drawn]
        assert rows[:, :7] == pytest.approx(np.vstack([own[:, None] * q, -others.T @ q]), abs=1e-3)
    assert g_q == pytest.approx(want_q, abs=1e-3)


def test_words_and_their_endings():
    """Endings of one, two and more bytes, ranks, and words that aren't known."""
    texts = pa.array(["a bb \u00e9 \u00fcber", None, "x" * 40 + " bb c"]).slice(0)
    distinct = lm.words(texts).distinct
    assert lm.endings_of(distinct, 64).tolist() == [lm.ending(w, 64) for w in distinct.to_pylist()]
    assert lm.endings_of(distinct.slice(2), 8).tolist() == [lm.ending(w, 8) for w in distinct.to_pylist()[2:]]
    assert lm.endings_of(distinct.slice(0, 0), 8).tolist() == []
    vocab = lm.Vocabulary({b"bb": 0, b"a": 1}, np.array([9, 4, 0]), np.array([0, 1, -1]), np.array([2, 3]), np.array([10.0, 100.0]), 4, np.ones(5), 13, 2)
    found, n, cls, norm = vocab.codes(texts)
    by_word = dict(zip(found.distinct.to_pylist(), zip(n.tolist(), cls.tolist(), norm.tolist(), strict=True), strict=True))
    assert by_word[b"bb"] == (9, 0, 0.0) and by_word[b"a"] == (4, 1, 0.0)
    e = lm.ending(b"c", 2)
    assert by_word[b"c"] == (0, 2 + e, 1.0 + e)


def test_lm_of_nothing(spark):
    assert lm.score(cases.empty(spark), Scratch(spark, "t")).collect() == []
    held = [(i, "a b", None, None, None) for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    got = lm.score(cases.frame(spark, held), Scratch(spark, "t"), classes=8).collect()
    assert {(r.n_known, r.train_tokens) for r in got} == {(0, 0)}
    assert all(np.isfinite(r.score) for r in got)


def test_language_sample_is_bounded(spark):
    """An id that repeats on most rows, and rows that repeat, do not widen the sample or change it."""
    rows = [(1, f"same id, text {i}", "en") for i in range(200)] + [(i, f"text {i}", "fr") for i in range(2, 40)]
    rows += [(5, "one row", "de")] * 100 + [(None, "no id", "de")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.sample_features(docs, 16, 20)
    by_language = {k: sum(r[0] == k for r in found) for k in ("de", "en", "fr")}
    assert by_language == {"de": 2, "en": 20, "fr": 20}
    again = langid.sample_features(docs.repartition(7, "text"), 16, 20)
    assert [(a, f.tolist(), x.tolist()) for a, f, x in found] == [(a, f.tolist(), x.tolist()) for a, f, x in again]
    assert langid.sample_features(docs.filter("false"), 16, 20) == []
