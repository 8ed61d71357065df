"""Documents with everything that real tables have: nulls, empty and long texts, ties, repeated rows, odd columns."""

import random

WORDS = "the of and to in a is that for it was on are as with his they at be this have from or one had by word but not what all were we when your can said there use an each which she do how their if will up other about out many then them these so some her would make like him into time has look two more write go see number no way could people my than first water been call who oil its now find long down day did get come made may part".split()
EXTRA = ["group", "class", "row", "word", "n", "shard", "load", "_row", "_text", "_base", "score", "lang_pred", "part", "trusted", "u", "v"]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + "x" if r.random() < share else w for w in text.split(" "))


def rows():
    base, other = prose(1, 120), prose(2, 300)
    texts = [base, base, base + " ", edited(base, 1, 0.02), edited(base, 2, 0.03), edited(base, 3, 0.2), other, edited(other, 5, 0.01)]
    texts += [None, "", "   ", "\n\n\t", "one", "one", "ONE two three", "one two three four five", "É ß 中文 😀 " * 40, prose(3, 20_000)]
    texts += ["same line here\n" * 30, "x" * 5000, prose(4, 50).upper(), prose(5, 9)]
    docs = [(i, t, ["en", "fr", None][i % 3], f"src{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    docs += [docs[0], docs[0], docs[8]]  # repeated rows
    docs += [(None, prose(6, 30), "en", None, None)]
    return docs


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, docs=None, extra=True):
    df = spark.createDataFrame(rows() if docs is None else docs, SCHEMA)
    if extra:
        for c in EXTRA:
            df = df.withColumn(c, df["source"])
    return df


def empty(spark):
    return frame(spark, [])
