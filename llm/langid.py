"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Letters are lower-cased, everything else is a blank; n-grams of one to three characters with a letter are
hashed into 2^bits features. A feature's weight in a text is its share of the text's n-grams times its
inverse document frequency, which one pass counts over all training documents. The model is fitted on a
bounded sample, `per_language` documents of each language by order of a hash, with follow-the-regularised-
leader and elastic-net penalties, so most weights are zero. A part of the sample is held back to fit one
temperature, by which scores are divided before they become probabilities.

Defined cases. A text that is null or has no letter is `und` with score 0. Training rows without text, letters
or language teach nothing. Without any training row everything is `und`. Ties go to the language that
comes first. Repeated rows give repeated results. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm import tokens
from llm.common import give_back, steps
from llm.text import buffers, code_points

BITS, ORDERS, SCALE = 16, 3, 30.0
#: A step holds some 60 bytes for each character.
STEP = 1 << 20
UNKNOWN = "und"
_BLANK = 32
_FOLDED: list[np.ndarray] = []


def _folded() -> np.ndarray:
    """For each code point, the lower-case letter or a blank."""
    if not _FOLDED:
        fold = np.full(0x110000, _BLANK, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                fold[i] = ord(c.lower()[0])
        _FOLDED.append(fold)
    return _FOLDED[0]


def char_grams(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the n-grams at each character, one row for each n; which of them count; text offsets."""
    data, off = buffers(texts)
    bounds = code_points(data)[off]
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    x = _folded()[chars] if len(chars) else np.zeros(0, np.uint32)
    n = len(x)
    padded = np.concatenate([x, np.full(ORDERS, _BLANK, np.uint32)])
    end = np.repeat(bounds[1:], np.diff(bounds))  # of the text that a character is in
    grams, counted = np.zeros((ORDERS, n), np.uint32), np.zeros((ORDERS, n), bool)
    h = np.zeros(n, np.uint32)
    letter = np.zeros(n, bool)
    at = np.arange(n)
    for k in range(ORDERS):
        c = padded[k : k + n]
        h = (h ^ c) * np.uint32(0x9E3779B1) + np.uint32(k + 1)
        letter |= c != _BLANK
        grams[k] = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - bits)
        counted[k] = letter & (at + k < end)
    return grams, counted, bounds


@dataclass
class Model:
    languages: list[str]
    bias: np.ndarray
    weights: np.ndarray  # languages by features, the inverse document frequency included
    temperature: float


def document_frequencies(docs: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """In how many texts each feature occurs, over all of them, and how many texts have any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        total = np.zeros((1 << bits) + 1, np.int64)
        for batch in steps(batches, STEP):
            grams, counted, bounds = char_grams(batch.column("text"), bits)
            for a, b in zip(bounds, bounds[1:], strict=False):
                met = np.zeros((1 << bits) + 1, np.int64)
                met[grams[:, a:b][counted[:, a:b]]] = 1
                met[-1] = met.any()
                total += met
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["feature", "n"])

    out = np.zeros((1 << bits) + 1, np.int64)
    found = docs.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    out[found.column("feature").to_numpy()] = found.column("n").to_numpy()
    return out[:-1], int(out[-1])


def sample_features(docs: DataFrame, bits: int, per_language: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """lang, features and shares of at most `per_language` documents of each language, equal rows counted once.

    They are those with the smallest hashes. A limit for the hash, from the approximate number of different rows,
    leaves somewhat more than that many before anything is ordered.
    """
    space = 1 << 32
    keyed = docs.select("lang", "text", F.xxhash64("doc_id", "lang", "text").alias("key"))
    counted = keyed.groupBy("lang").agg(F.approx_count_distinct("key", 0.02).alias("n")).collect()  # a row for each language
    if not counted:
        return []
    limits = [x for r in counted for x in (F.lit(r["lang"]), F.lit(min(space, int(space * 1.3 * per_language / r["n"]) + 1)))]
    drawn = keyed.filter(F.pmod("key", F.lit(space)) < F.create_map(*limits)[F.col("lang")])
    order = Window.partitionBy("lang").orderBy(F.pmod("key", F.lit(space)), "key")
    drawn = drawn.dropDuplicates(["lang", "key"]).withColumn("k", F.row_number().over(order))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for batch in steps(batches, STEP):
            grams, counted, bounds = char_grams(batch.column("text"), bits)
            rows = []
            for lang, a, b in zip(batch.column("lang").to_pylist(), bounds, bounds[1:], strict=False):
                features, n = np.unique(grams[:, a:b][counted[:, a:b]], return_counts=True)
                if len(features):
                    rows.append((lang, features.astype(np.int32), (n / n.sum()).astype(np.float32)))
            if rows:
                langs, features, shares = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs), pa.array(features, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))],
                    ["lang", "features", "shares"],
                )

    texts = drawn.filter(F.col("k") <= per_language).select("lang", "text")
    table = texts.mapInArrow(make, "lang string, features array<int>, shares array<float>").toArrow()
    rows = []
    for batch in table.to_batches():  # as arrays, for the driver's memory
        ends = batch.column("features").offsets.to_numpy()
        features, shares = (batch.column(c).values.to_numpy() for c in ("features", "shares"))
        for lang, a, b in zip(batch.column("lang").to_pylist(), ends, ends[1:], strict=False):
            rows.append((lang, features[a:b], shares[a:b]))
    return sorted(rows, key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))


def fit(
    rows: list[tuple[str, np.ndarray, np.ndarray]],
    idf: np.ndarray,
    epochs: int = 3,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.01,
    held_back: float = 0.2,
) -> Model:
    """Follow the regularised leader, coordinate by coordinate, and a temperature from the rows held back."""
    languages = sorted({r[0] for r in rows})
    z = np.zeros((len(languages), len(idf) + 1))  # the last feature is the bias
    squares = np.zeros_like(z)
    rng = np.random.default_rng(7)
    order = rng.permutation(len(rows))
    back = order[: int(held_back * len(rows))]
    fitted = order[len(back) :]

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[:, at]
        w = -(own - np.sign(own) * l1) / ((beta + np.sqrt(squares[:, at])) / alpha + l2)
        return np.where(np.abs(own) <= l1, 0.0, w)

    def values(row: tuple[str, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.append(row[1], len(idf)), np.append(row[2] * idf[row[1]] * SCALE, 1.0)

    def softmax(s: np.ndarray) -> np.ndarray:
        e = np.exp(s - s.max())
        return e / e.sum()

    for _ in range(epochs):
        for i in rng.permutation(fitted):
            at, x = values(rows[i])
            w = weights(at)
            g = softmax(w @ x)
            g[languages.index(rows[i][0])] -= 1
            g = g[:, None] * x
            step = (np.sqrt(squares[:, at] + g * g) - np.sqrt(squares[:, at])) / alpha
            z[:, at] += g - step * w
            squares[:, at] += g * g
    w = weights(np.arange(len(idf) + 1))
    logits = [(w[:, at] @ x, languages.index(rows[i][0])) for i in back for at, x in [values(rows[i])]]
    temperatures = np.exp(np.linspace(-2, 3, 101))
    loss = [sum(-np.log(max(softmax(s / t)[k], 1e-12)) for s, k in logits) for t in temperatures]
    best = float(temperatures[int(np.argmin(loss))]) if logits else 1.0
    return Model(languages, w[:, -1], w[:, :-1] * idf * SCALE, best)


def train(docs: DataFrame, per_language: int = 1000, bits: int = BITS) -> Model | None:
    """A model from the text and lang of the given rows."""
    docs = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long"), "lang", "text")
    df, texts = document_frequencies(docs, bits)
    rows = sample_features(docs, bits, per_language)
    if not rows:
        return None
    model = fit(rows, np.log((1 + texts) / (1 + df)) + 1)
    del rows  # the driver's memory is for the stages after
    give_back()
    return model


def rated(docs: DataFrame, model: Model | None, bits: int = BITS) -> DataFrame:
    """row, a struct of all columns of docs, lang_pred and score; only text is looked at."""
    fixed = 1 << 20
    text = docs.columns.index("text")

    def shown(batch: pa.RecordBatch) -> pa.RecordBatch:
        row = batch.column("row")
        return pa.RecordBatch.from_arrays([row, row.field(text)], ["row", "text"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        if model:
            weights = np.rint(model.weights * fixed).astype(np.int64)
        for batch in steps(map(shown, batches), STEP):
            grams, counted, bounds = char_grams(batch.column("text"), bits)
            n = np.diff(np.concatenate([[0], np.cumsum(counted.sum(axis=0))])[bounds])
            sums = np.zeros((len(model.languages) if model else 1, len(n)))
            for k in range(len(sums) if model else 0):
                # Whole numbers, so that a text's sum doesn't depend on the texts beside it.
                value = sum(np.where(counted[o], weights[k][grams[o]], 0) for o in range(ORDERS))
                sums[k] = np.diff(np.concatenate([[0], np.cumsum(value)])[bounds]) / fixed
            if model:
                logits = (sums / np.maximum(n, 1) + model.bias[:, None]) / model.temperature
                p = np.exp(logits - logits.max(axis=0))
                p /= p.sum(axis=0)
                known = n > 0
                language = [model.languages[i] if ok else UNKNOWN for i, ok in zip(p.argmax(axis=0), known, strict=True)]
                score = np.where(known, p.max(axis=0), 0.0)
            else:
                language, score = [UNKNOWN] * len(n), np.zeros(len(n))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(language, pa.string()), pa.array(score, pa.float64())], ["row", "lang_pred", "score"]
            )

    rows = docs.select(F.struct("*").alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(make, schema)


def predict(docs: DataFrame, model: Model | None, bits: int = BITS) -> DataFrame:
    """The columns of docs with lang_pred and score behind them."""
    fields = [F.col("row").getField(c).alias(c) for c in docs.columns]
    return rated(docs, model, bits).select(*fields, "lang_pred", "score")
