"""Language-model scoring with a two-level log-bilinear model trained by noise-contrastive estimation.

Words of all training texts are counted. The most frequent words, about eight times the square root of the training
tokens and so more of them in a larger corpus, are classes of their own, as is the end of a text; every other word belongs
to one of 64 classes by its last two bytes. The model gives each class a vector, a bias and a context vector;
the two classes before a token predict its vector by position-wise weights. Classes in order of frequency are
cut into groups that widen from 2 classes on by 4 from group to group, so that frequent classes are in small ones. Products of the prediction with all groups' vectors,
normalised, give the probability of the group; products with the vectors of the group's classes, normalised, that
of the class. So a token costs at most about four times the square root of the classes. The probability of a word in a class
by ending is that of the class times the word's smoothed share of it, in which one more share stands for all
unknown words with such an ending. So the probabilities of all words, the unknown by their endings, and the end add up to 1.

Training is noise-contrastive on both levels: real tokens and groups are told from ones drawn by frequency, by the
same batch of noise for a whole minibatch, so that every step is a few matrix products. A first model is fitted to a
bounded sample of texts; then every task trains it on all of its share of the training texts, and the
tasks' models are averaged, each class by how often a task met it.

The counts of all words stay a table. The most frequent, at most `sent`, 2^18 by default, go to every task; what
is rarer meets the table in a join. `sent` also bounds the classes, whose model of 200 bytes a class goes to every task.
Training depends on how rows are split into tasks, so scores differ slightly between clusters.

Defined cases. A null text is empty and has the end alone. Without any training text, counts are zero and
the base score of every token is log10(1 / (V + 1)) with V = 0. Repeated rows train and score repeatedly. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import Scratch, crc_mod, most_frequent, one_thread, steps
from llm.text import bytes_list, words

DIMENSION, SENT, ENDINGS, BLOCK, PART = 24, 1 << 18, 64, 4096, 256
_CELLS = 1 << 16  # of a table of scores that stays in a core's cache
_HELD = 300_000


def word_counts(docs: DataFrame) -> DataFrame:
    """word (bytes, A-Z lower-cased) and n of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in steps(batches):
            found = words(batch.column("text"))
            counts = np.bincount(found.codes, minlength=len(found.distinct))
            for word, n in zip(bytes_list(found.distinct), counts.tolist(), strict=True):
                held[word] = held.get(word, 0) + n
            if len(held) > _HELD:
                yield out()
                held = {}
        yield out()

    return docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def classes_for(tokens: int, sent: int = SENT) -> int:
    """How many classes a corpus of so many tokens gets."""
    return max(1024, min(sent, 8 * math.isqrt(tokens)))


def ending(word: bytes, endings: int) -> int:
    return zlib.crc32(word[-2:]) % endings


@functools.cache
def _crcs() -> tuple[np.ndarray, np.ndarray]:
    """The crc32 of every two bytes, the first one counting 256, and of every single byte."""
    two = np.fromiter((zlib.crc32(i.to_bytes(2, "big")) for i in range(1 << 16)), np.int64, 1 << 16)
    return two, np.fromiter((zlib.crc32(bytes([i])) for i in range(256)), np.int64, 256)


def endings_of(found: pa.Array, endings: int) -> np.ndarray:
    """:func:`ending` of every word of a large binary column without nulls or empty words."""
    if not len(found):
        return np.zeros(0, np.int64)
    _, offsets, data = found.buffers()
    off = np.frombuffer(offsets, np.int64, len(found) + 1, found.offset * 8)
    raw = np.frombuffer(data, np.uint8)
    two, one = _crcs()
    last, single = off[1:] - 1, np.diff(off) == 1
    crc = two[raw[np.maximum(last - 1, 0)].astype(np.int64) * 256 + raw[last]]
    crc[single] = one[raw[last[single]]]
    return crc % endings


def ending_of(word: str, endings: int):
    """The same as a column."""
    return F.pmod(F.crc32(F.expr(f"substring({word}, -2)")), F.lit(endings)).cast("int")


@dataclass
class Vocabulary:
    """The most frequent words by rank, counts and classes by rank, counts of the classes, totals over all words and ends."""

    rank: dict[bytes, int]
    count: np.ndarray
    cls: np.ndarray
    rare: np.ndarray
    rare_norm: np.ndarray
    end: int
    class_counts: np.ndarray
    total: int
    distinct: int

    @property
    def start(self) -> int:
        """What stands before a text; it only ever is a context."""
        return len(self.class_counts)

    def codes(self, texts: pa.Array):
        """The words of the texts, and for each distinct one its count, 0 if not here, its class and the log10 of its class's norm.

        The norm is 0 for words that are classes of their own.
        """
        found = words(texts)
        at = np.fromiter(map(self.rank.get, bytes_list(found.distinct), repeat(-1)), np.int64, len(found.distinct))
        n, c = self.count[at], self.cls[at]
        norm = np.zeros(len(at))
        others = np.flatnonzero(c < 0)
        by = endings_of(found.distinct, len(self.rare))[others]
        c[others], norm[others] = self.rare[by], np.log10(self.rare_norm[by])
        return found, n, c, norm


def vocabulary(counts: DataFrame, ends: int, classes: int | None, sent: int) -> Vocabulary:
    by_ending = counts.groupBy(ending_of("word", 1 << 10).alias("e")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    total, distinct = sum(r["n"] for r in by_ending), sum(r["words"] for r in by_ending)
    classes = classes_for(total + ends, sent) if classes is None else classes
    endings = min(ENDINGS, 1 << int(math.log2(max(1, classes // 4))))  # a power of two, so it divides 2^10
    rare_n, rare_words = np.zeros(endings, np.int64), np.zeros(endings, np.int64)
    for r in by_ending:
        rare_n[r["e"] % endings] += r["n"]
        rare_words[r["e"] % endings] += r["words"]
    top = most_frequent(counts, sent)
    pairs = sorted(zip(top.column("n").to_pylist(), top.column("word").to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    own = pairs[: max(0, classes - endings - 2)]
    for n, w in own:
        rare_n[ending(w, endings)] -= n
        rare_words[ending(w, endings)] -= 1
    numbers = np.array([*rare_n, ends, *(n for n, _ in own)], np.int64)
    order = np.argsort(-numbers, kind="stable")
    place = np.empty(len(numbers), np.int64)
    place[order] = np.arange(len(numbers))
    # What stands at -1 is for words that aren't here.
    cls = np.full(len(pairs) + 1, -1, np.int64)
    cls[: len(own)] = place[endings + 1 :]
    count = np.array([*(n for n, _ in pairs), 0], np.int64)
    return Vocabulary(
        {w: i for i, (_, w) in enumerate(pairs)}, count, cls, place[:endings], rare_n + 0.5 * (rare_words + 1), int(place[endings]), numbers[order], total + ends, distinct + (ends > 0)
    )


def sequences(found, cls: np.ndarray, end: int, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of every token with the ends, and of the two tokens before it."""
    first = found.first
    rows = len(first) - 1
    at = np.arange(len(found.codes)) + np.repeat(np.arange(rows), np.diff(first))
    target = np.full(len(found.codes) + rows, end, np.int64)
    target[at] = cls[found.codes]
    before = np.full(len(target), start, np.int64)
    before[1:] = target[:-1]
    begin = first[:-1] + np.arange(rows)
    before[begin] = start
    second = np.full(len(target), start, np.int64)
    second[1:] = before[:-1]
    second[begin] = start
    return target, before, second


def group_of(classes: np.ndarray) -> np.ndarray:
    """Group g holds the classes from 2 g^2 on."""
    return np.sqrt(classes // 2).astype(np.int64)


class Level:
    """Vectors and biases of what one level chooses from, and the noise that training tells it from.

    `rows` holds both, the bias last; a prediction has a last column of ones, which takes the biases along in products.
    """

    def __init__(self, noise: np.ndarray, vectors: np.ndarray):
        self.log_noise = np.log(noise).astype(np.float32)
        self.rows = np.column_stack([vectors, self.log_noise])
        self.vectors, self.bias = self.rows[:, :-1], self.rows[:, -1]
        self.cumulated = np.cumsum(noise)

    def draw(self, rng, k: int) -> np.ndarray:
        return np.minimum(np.searchsorted(self.cumulated, rng.random(k) * self.cumulated[-1]), len(self.rows) - 1)


def contrast(q: np.ndarray, levels: list[tuple[Level, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The gradient by q, and for each level those of the rows of its real ones and of its drawn ones.

    A level comes with the real ones of the tokens and with drawn ones that all tokens share.
    """
    log_k = np.float32(np.log(len(levels[0][2])))
    noise = np.concatenate([level.rows.take(drawn, axis=0) for level, _, drawn in levels])
    other, half = np.ascontiguousarray(noise[:, :-1]), np.ascontiguousarray(noise.T)
    half[-1] -= np.concatenate([level.log_noise.take(drawn) for level, _, drawn in levels]) + log_k
    half /= 2
    # P(real) of the drawn ones is (1 + tanh(score / 2)) / 2. For a whole minibatch these are most of a step, so those of all
    # levels are worked out together, in parts that stay in a core's cache.
    g_q, by_drawn = np.empty((len(q), q.shape[1] - 1), np.float32), np.zeros_like(half)
    for i in range(0, len(q), PART):
        part = q[i : i + PART]
        curve = part @ half
        np.tanh(curve, out=curve)
        np.matmul(curve, other, out=g_q[i : i + PART])
        by_drawn += part.T @ curve
    g_q += other.sum(axis=0)
    g_q /= -2
    by_drawn += q.sum(axis=0)[:, None]
    by_drawn /= -2
    out, at = [], 0
    for level, t, drawn in levels:
        own = level.rows.take(t, axis=0)
        real = np.einsum("ij,ij->i", q, own) - level.log_noise.take(t) - log_k
        g_real = ((1 - np.tanh(real / 2)) / 2)[:, None]  # P(noise) of the real ones
        own *= g_real
        g_q += own[:, :-1]
        rows = np.zeros((len(t) + len(drawn), q.shape[1] + q.shape[1] % 2), np.float32)
        np.multiply(q, g_real, out=rows[: len(t), : q.shape[1]])
        rows[len(t) :, : q.shape[1]] = by_drawn[:, at : at + len(drawn)].T
        out.append(rows)
        at += len(drawn)
    return g_q, out


def sums_by(place: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The sums of the rows at each of n places, all of which occur. Columns in pairs are added as complex numbers, two at a time."""
    order = np.argsort(place.astype(np.uint16) if n <= 1 << 16 else place, kind="stable")
    counts = np.bincount(place, minlength=n)
    first = np.cumsum(counts) - counts
    out = rows.take(order[first], axis=0)
    many = np.flatnonzero(counts > 1)  # most occur once
    if len(many):
        counts = counts[many]
        ordered = rows.take(order[np.repeat(first[many] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())], axis=0)
        if rows.shape[1] % 2 == 0:
            ordered = ordered.view(np.complex64)
        out[many] = np.add.reduceat(ordered, np.cumsum(counts) - counts, axis=0).view(np.float32)
    return out


class LogBilinear:
    """Classes in groups of consecutive ones, and position weights of the two classes before.

    The last row of the context vectors is that of a text's start.
    """

    def __init__(self, noise: np.ndarray, dimension: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        n = len(noise)
        noise = np.maximum(noise / max(noise.sum(), 1e-9), 1e-9)
        self.edges = 2 * np.arange(group_of(np.array([n - 1]))[0] + 2) ** 2
        self.edges[-1] = n
        small = lambda rows: rng.normal(0, 0.1, (rows, dimension)).astype(np.float32)
        self.words = Level(noise, small(n))
        self.groups = Level(np.add.reduceat(noise, self.edges[:-1]), small(len(self.edges) - 1))
        self.context = small(n + 1)
        self.position = np.ones((2, dimension), np.float32)
        self.squares: dict[str, np.ndarray] = {}
        self.met: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def classes(self) -> np.ndarray:
        """A row for every class and the start: context, vector, bias."""
        own = self.words.rows
        return np.column_stack([self.context, np.vstack([own, np.zeros_like(own[:1])])])

    def shared(self) -> np.ndarray:
        return np.concatenate([self.groups.vectors.ravel(), self.groups.bias, self.position.ravel()])

    def load(self, classes: np.ndarray, shared: np.ndarray) -> None:
        d = self.context.shape[1]
        self.context[...] = classes[:, :d]
        self.words.vectors[...] = classes[:-1, d : 2 * d]
        self.words.bias[...] = classes[:-1, 2 * d]
        at = 0
        for p in (self.groups.vectors, self.groups.bias, self.position):
            p[...] = shared[at : at + p.size].reshape(p.shape)
            at += p.size

    def predicted(self, first: np.ndarray, then: np.ndarray) -> np.ndarray:
        """What the context vectors predict, with a last column of ones."""
        q = np.ones((len(first), first.shape[1] + 1), np.float32)
        np.multiply(first, self.position[0], out=q[:, :-1])
        q[:, :-1] += then * self.position[1]
        return q

    def train(self, target: np.ndarray, before: np.ndarray, second: np.ndarray, rng, rate: float, batch: int = 4096, k: int = 64) -> None:
        """One turn over the tokens. Each is told from k noise classes, and its group from k noise groups.

        Steps are scaled by the gradients that a row has had before (AdaGrad, one number for each row). Only rows that
        a minibatch meets are touched, so its cost doesn't depend on the number of classes.
        """
        group, d = group_of(target), self.context.shape[1]
        for i in range(0, len(target), batch):
            t, g, b, s = target[i : i + batch], group[i : i + batch], before[i : i + batch], second[i : i + batch]
            first, then = self.context.take(b, axis=0), self.context.take(s, axis=0)
            q = self.predicted(first, then)
            drawn, from_groups = self.words.draw(rng, k), self.groups.draw(rng, k)
            g_q, (by_word, by_group) = contrast(q, [(self.words, t, drawn), (self.groups, g, from_groups)])
            self._step("words", np.concatenate([t, drawn]), rate, self.words.rows, by_word, d)
            self._step("groups", np.concatenate([g, from_groups]), rate, self.groups.rows, by_group, d)
            rows = np.empty((2, len(t), d), np.float32)
            np.multiply(g_q, self.position[:, None], out=rows)
            self._step("context", np.concatenate([b, s]), rate, self.context, rows.reshape(-1, d), d)
            moved = np.stack([np.einsum("ij,ij->j", g_q, first), np.einsum("ij,ij->j", g_q, then)])
            self._step("position", np.arange(2), rate, self.position, moved, d)

    def _step(self, name: str, at: np.ndarray, rate: float, values: np.ndarray, rows: np.ndarray, cut: int) -> None:
        """Adds to the values the scaled sums of the rows, by the rows' places. The columns before `cut` are scaled together, as
        are those from it on; columns that the values don't have are ignored."""
        n, width = values.shape
        columns = [slice(a, b) for a, b in ((0, cut), (cut, width)) if a < b]
        if name not in self.squares:
            self.squares[name] = np.full((len(columns), n), 1e-3, np.float32)
            self.met[name] = np.zeros(n, bool), np.zeros(n, np.int64)
        met, number = self.met[name]
        met[at] = True
        kinds = np.flatnonzero(met)
        met[kinds] = False
        number[kinds] = np.arange(len(kinds))
        change = sums_by(number[at], rows, len(kinds))[:, :width]
        for c, before in zip(columns, self.squares[name], strict=True):
            g = change[:, c]
            squares = before[kinds] + np.einsum("ij,ij->i", g, g) / np.float32(c.stop - c.start)
            before[kinds] = squares
            g *= (np.float32(rate) / np.sqrt(squares))[:, None]
        change += values.take(kinds, axis=0)
        values[kinds] = change

    def log10(self, target: np.ndarray, before: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of every token, in order of groups and in parts of bounded size."""
        group = group_of(target)
        order = np.argsort(group.astype(np.uint16), kind="stable")  # there are at most 2^15 groups
        out = np.empty(len(target))
        for i in range(0, len(order), 1 << 15):
            at = order[i : i + (1 << 15)]
            t, g = target.take(at), group.take(at)
            q = self.predicted(self.context.take(before.take(at), axis=0), self.context.take(second.take(at), axis=0))
            own = lambda level, k, q=q: np.einsum("ij,ij->i", q, level.rows.take(k, axis=0))
            logs = own(self.groups, g) - log_sums(q, self.groups.rows) + own(self.words, t)
            edges = np.append(np.flatnonzero(np.diff(g, prepend=-1)), len(g)).tolist()
            for a, b in zip(edges, edges[1:], strict=False):
                members = slice(self.edges[g[a]], self.edges[g[a] + 1])
                logs[a:b] -= log_sums(q[a:b], self.words.rows[members])
            out[at] = logs
        return out / np.log(10)


def log_sums(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The logarithm of each prediction's sum of exponentials over all rows."""
    out = np.empty(len(q), np.float32)
    ones = np.ones(len(rows), np.float32)
    size = max(16, _CELLS // len(rows))
    with np.errstate(over="ignore", divide="ignore"):
        for i in range(0, len(q), size):
            s = q[i : i + size] @ rows.T
            np.exp(s, out=s)
            np.log(s @ ones, out=out[i : i + size])
    beyond = np.flatnonzero(~(np.abs(out) < 60))  # what exponentials can't hold
    for i in range(0, len(beyond), size):
        at = beyond[i : i + size]
        s = q[at] @ rows.T
        top = s.max(axis=1, keepdims=True)
        out[at] = np.log(np.exp(s - top) @ ones) + top[:, 0]
    return out


def learnt(texts: DataFrame, vocab: Vocabulary, noise: np.ndarray, dimension: int, before: LogBilinear, turns: int, rate: float) -> LogBilinear:
    """The model after each task has trained on its texts from `before` on, averaged over the tasks.

    A class's row counts by how often it was met in the task, what all classes share by the task's tokens. Rows travel in
    blocks, block -1 being the shared part, and are added up by block, so no task holds more than a few.
    """
    classes, shared = before.classes(), before.shared()

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        own = LogBilinear(noise, dimension)
        own.load(classes, shared)
        task = TaskContext.get().partitionId()
        rng = np.random.default_rng(task)
        met = np.zeros(len(classes))
        for batch in steps(batches):
            found, _, cls, _ = vocab.codes(batch.column("text"))
            target, first, second = sequences(found, cls, vocab.end, vocab.start)
            for _ in range(turns):
                order = rng.permutation(len(target))
                own.train(target[order], first[order], second[order], rng, rate)
            met += np.bincount(target, minlength=len(met)) + np.bincount(first, minlength=len(met))
        if met.any():
            rows = own.classes() - classes
            for i in range(0, len(rows), BLOCK):
                yield block(i // BLOCK, task, met[i : i + BLOCK], rows[i : i + BLOCK])
            yield block(-1, task, met.sum(keepdims=True), (own.shared() - shared)[None, :])

    def block(number: int, pile: int, weights: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        return record(number, pile, weights, rows * weights[:, None])

    def record(number: int, pile: int, weights: np.ndarray, rows: np.ndarray, kind: str = "<f8") -> pa.RecordBatch:
        packed = [pa.array([x], pa.int64()) for x in (number, pile % 16)]
        packed += [pa.array([x.astype(kind).tobytes()], pa.binary()) for x in (weights, rows)]
        return pa.RecordBatch.from_arrays(packed, ["block", "pile", "weights", "rows"])

    def added(batches: Iterator[pa.RecordBatch]) -> dict[int, list[np.ndarray]]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for number, weights, rows in zip(*(batch.column(c).to_pylist() for c in ("block", "weights", "rows")), strict=True):
                w, r = np.frombuffer(weights, "<f8"), np.frombuffer(rows, "<f8")
                if number in held:
                    held[number][0] += w
                    held[number][1] += r
                else:
                    held[number] = [w.copy(), r.copy()]
        return held

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (w, r) in added(batches).items():
            yield record(number, 0, w, r)

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (w, r) in added(batches).items():
            yield record(number, 0, w[:0], r.reshape(len(w), -1) / np.maximum(w, 1)[:, None], "<f4")

    schema = "block long, pile long, weights binary, rows binary"
    piles = texts.select("text").mapInArrow(learn, schema).repartition("block", "pile").mapInArrow(add, schema)
    # No more than the model itself: some 200 bytes for each of at most `sent` classes.
    moved = piles.repartition("block").mapInArrow(mean, schema).select("block", "rows").toArrow()
    for number, rows in zip(moved.column("block").to_pylist(), moved.column("rows"), strict=True):
        change = np.frombuffer(rows.as_buffer(), "<f4")
        if number < 0:
            shared = shared + change
        else:
            change = change.reshape(-1, classes.shape[1])
            classes[number * BLOCK : number * BLOCK + len(change)] += change
    after = LogBilinear(noise, dimension)
    after.load(classes, shared)
    return after


def fit(training: DataFrame, vocab: Vocabulary, dimension: int = DIMENSION, warm_tokens: int = 500_000) -> LogBilinear:
    """A first model from a sample of about `warm_tokens` in one task, then all texts in all tasks.

    The sample is drawn by a hash of the row's place, so that repeated ids or rows don't enter it together.
    """
    noise = vocab.class_counts + 0.5
    model = LogBilinear(noise, dimension)
    if vocab.total:
        share = min(1.0, warm_tokens / vocab.total)
        drawn = F.pmod(F.xxhash64("_place"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
        sample = training.select("text", F.monotonically_increasing_id().alias("_place")).filter(drawn)
        model = learnt(sample.repartition(1), vocab, noise, dimension, model, 5, 0.1)
        model = learnt(training, vocab, noise, dimension, model, 1, 0.03)
    return model


def score(docs: DataFrame, scratch: Scratch, held_out_of: int = 5, held_out: int = 1, classes: int | None = None, sent: int = SENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    out = F.coalesce(crc_mod("doc_id", held_out_of) == held_out, F.lit(False))
    training = docs.filter(~out)
    counts = scratch.table(word_counts(training))
    ends = training.count()
    vocab = vocabulary(counts, ends, classes, sent)
    model = fit(training, vocab)
    base_norm = vocab.total + 0.5 * (vocab.distinct + 1)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        row = TaskContext.get().partitionId() << 33
        base_log = np.log10(base_norm)
        for batch in steps(batches):
            found, n, cls, norm = vocab.codes(batch.column("text"))
            rows = len(found.first) - 1
            target, before, second = sequences(found, cls, vocab.end, vocab.start)
            doc = np.repeat(np.arange(rows), np.diff(found.first) + 1)
            per_doc = lambda values, at: np.bincount(at, values, rows)
            modelled = per_doc(model.log10(target, before, second), doc)
            word_doc = np.repeat(np.arange(rows), np.diff(found.first))
            here = n[found.codes] > 0
            logs = np.log10(np.maximum(n, 1) + 0.5)
            share = np.where(norm > 0, logs - norm, 0.0)
            base = per_doc(np.where(here, logs[found.codes] - base_log, 0.0), word_doc) + np.log10(ends + 0.5) - base_log
            modelled += per_doc(np.where(here, share[found.codes], 0.0), word_doc)
            known = per_doc(here, word_doc) + (ends > 0)
            missing = np.flatnonzero(~here)
            at = np.searchsorted(word_doc[missing], np.arange(rows + 1))
            words_ = found.distinct.cast(pa.binary()).take(pa.array(found.codes[missing]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(rows)),
                    batch.column("doc_id"),
                    pa.array(np.diff(found.first) + 1),
                    pa.array(known.astype(np.int64)),
                    pa.array(base),
                    pa.array(modelled),
                    pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), words_),
                ],
                ["row", "doc_id", "n_tokens", "n_known", "base", "model", "rare"],
            )
            row += rows

    schema = "row long, doc_id long, n_tokens long, n_known long, base double, model double, rare array<binary>"
    found = scratch.table(docs.mapInArrow(make, schema))
    rare = found.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    n = F.coalesce(F.col("n"), F.lit(0))
    rare_norm = F.array(*[F.lit(float(x)) for x in np.log10(vocab.rare_norm)])
    rare = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * (F.log10(n + 0.5) - F.lit(float(np.log10(base_norm))))).alias("more_base"),
        F.sum(F.col("times") * (F.log10(n + 0.5) - F.element_at(rare_norm, ending_of("word", len(vocab.rare)) + 1))).alias("more_model"),
    )
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return found.drop("rare").join(rare, "row", "left").select(
        "doc_id",
        out.alias("held_out"),
        "n_tokens",
        plus("n_known", "more_known").alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        plus("base", "more_base").alias("base_score"),
        plus("model", "more_model").alias("score"),
    )
