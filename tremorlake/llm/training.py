"""Bounded labelled samples for the trained operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.common import ready


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of doc_id, as text, modulo ``folds``; null where doc_id is null."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: dict[int, int]) -> DataFrame:
    """(doc_id, label, text) of at most most[value] training rows of each label value.

    Rows of the held-out fold never count.  Of the rest the first by hash of
    doc_id are taken, so the sample is the same in every run and on any number
    of machines.  A doc_id with both labels, or none, is left out.  The ids are
    at most sum(most) rows, so they are broadcast to the scan of the texts.
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(*most) & (fold("doc_id", folds) != held_out))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label).alias("label"), F.max(label).alias("other"))
             .filter("label = other").select("doc_id", "label"))
    picked = None
    for value, n in most.items():
        part = known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        picked = part if picked is None else picked.unionByName(part)
    ready(docs.sparkSession)
    rows = picked.collect()
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["label"]) for r in rows], "doc_id long, label int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), "doc_id").select("doc_id", "label", "text")
