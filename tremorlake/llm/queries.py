"""The registered queries of this subpackage: op1 to op13 over their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm import (byte_bpe, decontaminate, exact_topk, language_id, license_scan, line_dedup, merkle, ngram_join, oracle, pii, quality,
                            secret_scan, toxicity, vector_codes)
from tremorlake.llm.common import table

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.floor(F.length("ids") / 4).alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).drop("row_hash")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.pseudonymise(table(spark, sf_dir, "documents")))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return tagged.withColumn("spans", F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["stop"])), ","))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.classify(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_byte_bpe, op3_ngram_jaccard_join, op4_pii, op5_secret_scan, op6_decontaminate, op7_quality,
    op8_exact_topk, op9_toxicity, op10_license_scan, op11_language_id, op12_merkle_manifest, op13_vector_codes)}

ORACLE: dict[str, str] = {
    "op1_line_dedup": oracle.LINE_DEDUP,
    "op5_secret_scan": oracle.SECRET_SCAN,
    "op8_exact_topk": oracle.EXACT_TOPK,
    "op10_license_scan": oracle.LICENSE_SCAN,
    "op12_merkle_manifest": oracle.MERKLE_MANIFEST,
    "op13_vector_codes": oracle.VECTOR_CODES,
}
