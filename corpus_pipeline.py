"""A training corpus from ``documents``: the stages in order, each written as Parquet and read again.

Every stage works on all rows that its predecessor kept.  All but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm import byte_bpe, decontaminate, line_dedup, ngram_join, quality
from tremorlake.llm.common import table
from tremorlake.llm.queries import BPE_RANKS
from tremorlake.session import remove_path, scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among ``docs``, rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share go from all of them; documents stay."""
    return line_dedup.dedup_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the one with the smallest doc_id."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def byte_pair_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): token ids of every text as an array of packed little-endian 32-bit integers.

    All ids are decoded again; a document that they do not give back whole stops the stage.
    """
    coded = byte_bpe.encode_documents(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN, verified=True)
    return coded.select("doc_id", F.floor(F.length("ids") / 4).alias("n_tokens"), "ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", byte_pair_encoding),
]

#: A trained model, near copies and edit distances are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole of ``documents``.  A stage's files go once the next stage is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
