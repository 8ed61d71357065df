"""A corpus pipeline: language, near duplicates, benchmark leaks, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of the
documents they got; what a stage drops or changes is gone for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import langid
from llm.common import Scratch, documents
from llm.decontamination import leaks
from llm.jaccard import jaccard_components
from llm.packing import pack, token_pieces
from llm.secrets import redact

#: A language is believed from this probability on; texts without letters never reach it.
LEAST_SCORE = 0.3
CAPACITY, END_ID = 1024, 2


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose doc_id isn't among those of the other table. Rows with a null id stay."""
    gone = gone.select(F.col("doc_id").alias("_gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone_id"], "left_anti")


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts whose language isn't recognised. The model learns from the given languages of all rows."""
    found = langid.rated(docs, langid.train(docs))
    kept = found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near duplicates. Rows repeated under that id all stay."""
    found = jaccard_components(docs, Scratch(spark, "jaccard"))
    return without(docs, found.filter("doc_id <> component_id"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that hold a benchmark passage."""
    return without(docs, leaks(docs, documents(spark, sf_dir, "benchmark")))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts, and counts their characters anew."""
    masked = redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    n_chars = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars.cast(kind))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most CAPACITY tokens with their sequences."""
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), CAPACITY, END_ID)
    return pack(pieces, Scratch(spark, "packing"), CAPACITY)


STAGES = [
    ("language_id", identified),
    ("ngram_jaccard", deduplicated),
    ("decontamination", decontaminated),
    ("secrets", redacted),
    ("packing", packed),
]

#: No stage before the last is expressible in SQL as a whole; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
