"""Quality classifier: supervised subword embeddings.

Every text is the average of learned vectors of its hashed words, marks of
repeated words and byte 4-grams; a softmax over that average gives the class.
Vectors and softmax are trained together by stochastic gradient descent in
numpy on a bounded sample of labelled rows (TRAIN_ROWS for each class).

Averaging and the softmax's logit are both linear, so a trained model is one
number for each bucket.  Scoring reads that table, which has a fixed size and
is broadcast, for every n-gram of the whole text.

Labels of the held-out fold are never read.  lang, source, doc_id and labels are
no inputs of a score.

Defined results: null or empty texts have no n-grams and get the score of the
bias alone.  Without labelled rows of both classes the model is empty and every
score is 0.5.  Rows that are repeated are scored alike.  An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.llm.common import shielding
from tremorlake.llm.text_arrays import PIECE_BYTES, mix, pieces, words
from tremorlake.llm.training import fold, labelled_sample

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
#: At most so many labelled rows of each class are learned from.
TRAIN_ROWS = 2500
BUCKET_BITS = 16
DIM = 8
EPOCHS = 12
BATCH = 64
RATE = 0.3


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, document) of the n-grams of a piece of texts, in blocks of bounded size."""
    top = np.uint64(64 - BUCKET_BITS)
    w = words(data, offsets, lower=False)
    again = np.flatnonzero((w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])) + 1
    mark = np.full(len(again), mix(np.array([7], np.uint64))[0] >> top, np.int32)
    yield np.concatenate([(w.hash >> top).astype(np.int32), mark]), np.concatenate([w.doc, w.doc[again]])
    del w, again, mark
    for at in range(0, len(data) - 3, PIECE_BYTES):
        part = data[at:at + PIECE_BYTES + 3]
        n = len(part) - 3
        x = part[:n].astype(np.uint32)
        for k in (1, 2, 3):
            x |= part[k:n + k].astype(np.uint32) << np.uint32(8 * k)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(np.clip(offsets, at, at + n + 3)))
        same = doc[:n] == doc[3:]
        gram = ((x * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)
        yield gram[same], doc[:n][same]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) -> (label, buckets, shares): the distinct buckets of each text, packed."""
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False)
        for lo, data, offsets in pieces(batch.column(1)):
            counted = [np.unique(doc.astype(np.int64) << BUCKET_BITS | bucket, return_counts=True) for bucket, doc in features(data, offsets)]
            key, inverse = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
            count = np.bincount(inverse, weights=np.concatenate([c for _, c in counted]), minlength=len(key))
            ids, shares = [], []
            cut = np.searchsorted(key, np.arange(len(offsets)) << BUCKET_BITS)
            for a, b in zip(cut, cut[1:], strict=False):
                ids.append((key[a:b] & ((1 << BUCKET_BITS) - 1)).astype("<i4").tobytes())
                shares.append((count[a:b] / max(1, count[a:b].sum())).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(label[lo:lo + len(ids)], pa.int32()), pa.array(ids, pa.binary()), pa.array(shares, pa.binary())],
                                             ["label", "ids", "shares"])


def train(samples: list[tuple[int, bytes, bytes]], seed: int = 1) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent over (label, buckets, shares); returns the table of logits and the bias."""
    rng = np.random.default_rng(seed)
    n_buckets = 1 << BUCKET_BITS
    if len({s[0] for s in samples}) < 2:
        return np.zeros(n_buckets, np.float32), 0.0
    vector = rng.normal(0, 0.1, (n_buckets, DIM)).astype(np.float32)
    out, bias = rng.normal(0, 0.5, (2, DIM)).astype(np.float32), np.zeros(2, np.float32)
    sum_v, sum_o, sum_b = np.full((n_buckets, DIM), 1e-6, np.float32), np.full_like(out, 1e-6), np.full_like(bias, 1e-6)
    ids = [np.frombuffer(s[1], "<i4") for s in samples]
    shares = [np.frombuffer(s[2], "<f4") for s in samples]
    label = np.array([s[0] for s in samples])
    # Both classes weigh as in the sample's labels; the sample is balanced by its bounds only where rows abound.
    for _ in range(EPOCHS):
        order = rng.permutation(len(samples))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            i, s = np.concatenate([ids[r] for r in rows]), np.concatenate([shares[r] for r in rows])
            of = np.repeat(np.arange(len(rows)), [len(ids[r]) for r in rows])
            hidden = np.stack([np.bincount(of, weights=vector[i, k] * s, minlength=len(rows)) for k in range(DIM)], 1).astype(np.float32)
            logit = hidden @ out.T + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), label[rows]] -= 1
            g_out, g_bias, g_hidden = p.T @ hidden, p.sum(0), p @ out
            u, inverse = np.unique(i, return_inverse=True)
            g = np.stack([np.bincount(inverse, weights=g_hidden[of, k] * s, minlength=len(u)) for k in range(DIM)], 1).astype(np.float32)
            sum_v[u] += g * g
            vector[u] -= RATE * g / np.sqrt(sum_v[u])
            sum_o += g_out * g_out
            out -= RATE * g_out / np.sqrt(sum_o)
            sum_b += g_bias * g_bias
            bias -= RATE * g_bias / np.sqrt(sum_b)
    return (vector @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT,
        rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    sample = labelled_sample(docs, labels, label, folds, held_out, {0: rows, 1: rows})
    counted = sample.select("label", "text").mapInArrow(_counted, "label int, ids binary, shares binary")
    return train(sorted((r["label"], bytes(r["ids"]), bytes(r["shares"])) for r in counted.collect()))


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """All columns of ``docs`` (which has ``text``) and ``__score``, the probability of label 1."""
    shared, bias = docs.sparkSession.sparkContext.broadcast(model[0]), model[1]
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for lo, data, offsets in pieces(batch.column(at)):
                n = len(offsets) - 1
                total, many = np.zeros(n), np.zeros(n)
                for bucket, doc in features(data, offsets):
                    total += np.bincount(doc, weights=table[bucket], minlength=n)
                    many += np.bincount(doc, minlength=n)
                logit = bias + total / np.maximum(1, many)
                made = pa.array(1 / (1 + np.exp(-np.clip(logit, -40, 40))), pa.float64())
                rows = batch.slice(lo, n)
                yield pa.RecordBatch.from_arrays([*rows.columns, made], [*rows.schema.names, "__score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__score", T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit(docs, labels))
    return scored.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                         F.col("__score").alias("score"), (F.col("__score") >= threshold).cast("int").alias("predicted"))


@shielding
def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    scored = score(docs, fit(docs, labels))
    return scored.filter(F.col("__score") >= threshold).select(*[scored[c] for c in docs.columns])
