"""The operators as queries over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import Scratch, crc_mod, documents
from llm.decontamination import leaks
from llm.huffman import read_blocks, write_token_files
from llm.jaccard import jaccard_components
from llm import langid, lm, merkle
from llm.licenses import scan as scan_licenses
from llm.licenses import scan_sql as license_sql
from llm.packing import pack, token_pieces
from llm.pii import scan as scan_personal
from llm.quality import judge
from llm.repeats import periodic_runs
from llm.secrets import scan as scan_secrets
from llm.sharding import assign_shards

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), Scratch(spark, "jaccard"))


@query
def op2_log_bilinear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir), Scratch(spark, "lm"))


@query
def op3_huffman_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    scratch = Scratch(spark, "token-files")
    return read_blocks(*write_token_files(documents(spark, sf_dir), scratch, path, end_id=2, spaces=False))


@query
def op4_trusted_ratio_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = documents(spark, sf_dir, "labels")
    trusted = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0")
    reason = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low quality")
    return judge(documents(spark, sf_dir), trusted, untrusted=labels.select("doc_id", reason.alias("reason")))


@query
def op5_bounded_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = assign_shards(documents(spark, sf_dir), shards=16)
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("home").alias("home_shard"),
    )


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    found = langid.predict(docs.select("doc_id", "text"), langid.train(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op7_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))


@query
def op8_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


ORACLES["op8_license_dice"] = license_sql()


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = token_pieces(documents(spark, sf_dir), path, capacity=1024, end_id=2)
    return pack(pieces, Scratch(spark, "packing"), capacity=1024)


@query
def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    # Every tenth document, by its checksum, is made periodic from some word on.
    rewritten = r"""CASE WHEN crc32(string(doc_id)) % 10 = 0 THEN
        transform(array(struct(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0) AS w, crc32(string(doc_id)) div 10 AS g)),
          x -> CASE WHEN size(x.w) = 0 THEN text ELSE
            transform(array(struct(int(x.g % size(x.w)) AS a, int(x.g % 8) AS k)), y ->
              transform(array(1 + (size(x.w) - y.a) div (3 + y.k)), p ->
                array_join(transform(x.w, (word, i) -> CASE WHEN i >= y.a THEN x.w[int(y.a + (i - y.a) % p)] ELSE word END), ' '))[0])[0]
            END)[0]
        ELSE text END"""
    found = periodic_runs(docs.withColumn("text", F.expr(rewritten)))
    longest = "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS before, -r.period AS shorter)))"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return found.withColumn("best", F.expr(longest)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.expr("-best.before").alias("start"),
        F.col("best.length").alias("length"),
        F.expr("-best.shorter").alias("period"),
        F.expr("1000 * best.length div -best.shorter").alias("exponent_milli"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_personal(documents(spark, sf_dir))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(changed, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])
    keep = {"doc_id": F.col("doc_id"), "tampered": merkle.leaf(docs, columns, {"text": tampered})}
    leaf = merkle.leaf(docs, columns)
    proofs = merkle.manifest(docs, Scratch(spark, "merkle"), "source", "doc_id", leaf, keep).proofs()
    return (
        proofs.withColumn("proof_sha256", F.sha2(merkle.siblings(F.col("proof")), 256))
        .withColumn("folded_root", merkle.folded(F.col("tampered"), F.col("proof")))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
        .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    )


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
