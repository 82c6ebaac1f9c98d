"""Toxicity: a linear-chain conditional random field tags toxic words.

Each word of a text is toxic or not.  A word's emission is the sum of learned
weights of its hashed features (the word, its first bytes, these with its
length); neighbouring words are tied by learned transitions.  Forward and
backward passes give each word's exact marginal; sums of a text's marginals,
weighed by a logistic regression, make its score, and high marginals its
offending spans.

Labelled words are made from labelled documents (a bounded sample): a word of a
toxic document is toxic if one of its features is MIN_LIFT times as frequent in
toxic documents as in others and has the support of MIN_DOCS of them; copies of
a document, and documents with other marked words, support less.

With two states a message is one number, the odds of "toxic", and a word maps
odds to odds by a fraction of two linear terms.  Such maps compose, so all words
of a batch are one chain, cut at text borders and worked on in parallel blocks.

Labels of the held-out fold are never read.  lang, source, doc_id and labels are
no inputs of a score.

Defined results: null or empty texts have no words and score 0.  Without
labelled rows of both classes every score is 0 or next to it (under 1e-12).  Rows that are repeated are
scored alike.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.text_arrays import mix, pieces, words
from tremorlake.llm.training import fold, labelled_sample

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: At most so many labelled rows of each class are learned from.
TRAIN_TOXIC, TRAIN_CLEAN = 1000, 1500
BUCKET_BITS = 18
PREFIX_BYTES = 6
MIN_DOCS, MIN_LIFT = 2.5, 20.0
STEPS, RATE, SHRINK = 20, 0.5, 1e-4
#: Marginals from here on add up to the score and make spans.
SPAN_AT = 0.5
COUNTED = 0.1


class Model(NamedTuple):
    """Weights of the buckets, bias of "toxic", transition factors [from, to], odds at a text's start; weights of a text's sums."""

    weight: np.ndarray
    bias: float
    factor: np.ndarray
    start: float
    document: np.ndarray


def word_features(data: np.ndarray, offsets: np.ndarray):
    """(words, buckets): buckets[k] is feature k of every word."""
    w = words(data, offsets)
    short = np.minimum(w.stop, w.start + PREFIX_BYTES)
    key = np.zeros(len(w.start), np.uint64)
    for k in range(PREFIX_BYTES):  # the first bytes, lower-cased for ASCII
        at = np.minimum(w.start + k, max(0, len(data) - 1))
        byte = data[at].astype(np.uint64)
        byte += np.where((byte >= 65) & (byte <= 90), 32, 0).astype(np.uint64)
        key = key << np.uint64(8) | np.where(w.start + k < short, byte, 0)
    top = np.uint64(64 - BUCKET_BITS)
    prefix = mix(key + np.uint64(1 << 56))
    length = mix((key << np.uint64(8)) + (w.stop - w.start).astype(np.uint64) + np.uint64(1 << 60))
    return w, np.stack([(x >> top).astype(np.int32) for x in (w.hash, prefix, length)])


def chain_odds(emission: np.ndarray, first: np.ndarray, factor: np.ndarray, start: float, block: int = 256) -> np.ndarray:
    """Odds of state 1 after each place of chains that begin where ``first`` is set; emission is a factor."""
    n = len(emission)
    if n == 0:
        return np.zeros(0)
    rows = -(-n // block)
    e, r = np.ones(rows * block), np.ones(rows * block, bool)
    e[:n], r[:n] = emission, first
    e, r = np.ascontiguousarray(e.reshape(rows, block).T), np.ascontiguousarray(r.reshape(rows, block).T)
    (f00, f01), (f10, f11) = factor
    # The map of a whole block: odds -> (a * odds + b) / (c * odds + d).
    a, b, c, d = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for t in range(block):
        a, c = e[t] * (f11 * a + f01 * c), f10 * a + f00 * c
        b, d = e[t] * (f11 * b + f01 * d), f10 * b + f00 * d
        if r[t].any():
            a, c = np.where(r[t], 0, a), np.where(r[t], 0, c)
            b, d = np.where(r[t], e[t] * start, b), np.where(r[t], 1, d)
        if t % 8 == 7:
            size = a + b + c + d
            a, b, c, d = a / size, b / size, c / size, d / size
    odds, o = np.empty(rows), 1.0
    for k, (ka, kb, kc, kd) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True)):
        odds[k] = o
        o = (ka * o + kb) / (kc * o + kd)
    out = np.empty((block, rows))
    for t in range(block):
        odds = e[t] * np.where(r[t], start, (f01 + odds * f11) / (f00 + odds * f10))
        out[t] = odds
    return out.T.reshape(-1)[:n]


def forward_backward(emission: np.ndarray, doc: np.ndarray, factor: np.ndarray, start: float):
    """(forward odds, backward odds times emission, marginals of state 1) of words sorted by document."""
    border = np.ones(len(doc) + 1, bool)
    border[1:-1] = doc[1:] != doc[:-1]
    ahead = chain_odds(emission, border[:-1], factor, start)
    back = chain_odds(emission[::-1], border[1:][::-1], factor.T, 1.0)[::-1]
    odds = ahead * back / emission
    return ahead, back, odds / (1 + odds)


def emissions(model_weight: np.ndarray, bias: float, buckets: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(bias + model_weight[buckets].sum(0, dtype=np.float64), -25, 25))


def copy_weights(doc: np.ndarray, word: np.ndarray, n: int, shingle: int = 5, hashes: int = 3) -> np.ndarray:
    """1 / (documents that look like copies of it), by the smallest hashes of runs of words."""
    weight = np.ones(n)
    if len(word) < shingle:
        return weight
    runs = np.zeros(len(word) - shingle + 1, np.uint64)
    for k in range(shingle):
        runs = mix(runs + word[k:len(word) - shingle + 1 + k].astype(np.uint64) + np.uint64(1))
    of = doc[:len(runs)]
    inside = of == doc[shingle - 1:]
    runs, of = runs[inside], of[inside]
    if len(of) == 0:
        return weight
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    for k in range(hashes):
        least = np.minimum.reduceat(mix(runs ^ np.uint64(k * 0x9E37 + 1)), first)
        _, inverse, count = np.unique(least, return_inverse=True, return_counts=True)
        weight[of[first]] = np.minimum(weight[of[first]], 1 / count[inverse])
    return weight


def label_words(doc: np.ndarray, toxic: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """1 for the words of toxic documents with a feature that marks such documents.

    Features are marked one after another, the most supported first.  A toxic
    document counts less with every mark it has, so words that merely stand
    beside marked ones, and words of copies of a few documents, find no support.
    """
    n, size = len(toxic), 1 << BUCKET_BITS
    own = copy_weights(doc, buckets[0], n)
    keys = [np.unique((doc.astype(np.int64) << (BUCKET_BITS + 1)) | (kind << BUCKET_BITS) | buckets[row]) for kind, row in enumerate((0, 2))]
    pair = np.concatenate(keys)
    of, feature = pair >> (BUCKET_BITS + 1), pair & (2 * size - 1)
    n_toxic, n_clean = own[toxic].sum(), own[~toxic].sum()
    clean = np.bincount(feature[~toxic[of]], weights=own[of[~toxic[of]]], minlength=2 * size)
    of, feature = of[toxic[of]], feature[toxic[of]]
    order = np.argsort(feature, kind="stable")
    of, feature = of[order], feature[order]
    total = np.bincount(feature, weights=own[of], minlength=2 * size)
    able = (total >= MIN_DOCS) & (total / n_toxic >= MIN_LIFT * (clean + 0.5) / n_clean)
    marks, has = np.zeros(2 * size, bool), np.zeros(n)
    held = able[feature]
    of, feature = of[held], feature[held]
    for _ in range(int(able.sum())):
        support = np.bincount(feature, weights=(own / (1 + has))[of], minlength=2 * size)
        support[marks] = 0
        best = int(support.argmax())
        if support[best] < MIN_DOCS:
            break
        marks[best] = True
        has[of[feature == best]] += 1
    return ((marks[buckets[0]] | marks[size + buckets[2]]) & toxic[doc]).astype(np.float64)


def document_sums(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """(n, 3): one; log odds that some word with a marginal of COUNTED or more (else the likeliest) is toxic; log of how many."""
    most = np.full(n, 1e-6)
    np.maximum.at(most, doc, p)
    big = p >= COUNTED
    none = np.bincount(doc[big], weights=np.log1p(-np.minimum(p[big], 1 - 1e-9)), minlength=n)
    some = np.clip(np.maximum(most, -np.expm1(none)), 1e-6, 1 - 1e-6)
    many = np.bincount(doc[big], weights=p[big], minlength=n)
    return np.stack([np.ones(n), np.log(some / (1 - some)), np.log1p(many)], 1)


def document_scores(p: np.ndarray, doc: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    """Score of every text from its words' marginals; a text without words has score 0."""
    score = 1 / (1 + np.exp(-np.clip(document_sums(p, doc, n) @ weights, -40, 40)))
    return np.where(np.bincount(doc, minlength=n) > 0, score, 0.0)


def weigh_sums(sums: np.ndarray, toxic: np.ndarray, shrink: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards the odds as they are."""
    prior = np.array([0.0, 1.0, 0.0])

    def loss(w):
        z = sums @ w
        return (np.logaddexp(0, z) - toxic * z).sum() + shrink / 2 * ((w - prior) ** 2).sum()

    w = prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(sums @ w, -30, 30)))
        slope = sums.T @ (toxic - p) - shrink * (w - prior)
        step = np.linalg.solve((sums * (p * (1 - p))[:, None]).T @ sums + shrink * np.eye(3), slope)
        while loss(w + step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w + step
    return np.array([w[0], max(w[1], 0.0), max(w[2], 0.0)])


def train(doc: np.ndarray, toxic: np.ndarray, buckets: np.ndarray) -> Model:
    """Maximum likelihood by gradient steps with exact marginals; documents are numbered, words sorted by them."""
    weight, bias = np.zeros(1 << BUCKET_BITS, np.float32), -3.0
    log_factor, log_start = np.zeros((2, 2)), 0.0
    if len(doc) == 0 or toxic.all() or not toxic.any():
        return Model(weight, -25.0, np.exp(log_factor), 1.0, np.array([-40.0, 0.0, 0.0]))
    y = label_words(doc, toxic, buckets)
    inner = np.flatnonzero(doc[1:] == doc[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner].astype(int), y[inner + 1].astype(int)), 1)
    square = np.full(len(weight), 1e-8)
    square_bias, square_factor = 1e-8, np.full((2, 2), 1e-8)
    for _ in range(STEPS):
        factor = np.exp(log_factor)
        emission = emissions(weight, bias, buckets)
        ahead, back, p = forward_backward(emission, doc, factor, np.exp(log_start))
        miss = y - p
        g = sum(np.bincount(row, weights=miss, minlength=len(weight)) for row in buckets) - SHRINK * weight
        square += g * g
        weight += (RATE * g / np.sqrt(square)).astype(np.float32)
        g = miss.sum()
        square_bias += g * g
        bias += RATE * g / np.sqrt(square_bias)
        o, x = ahead[inner], back[inner + 1]
        one = 1 / (factor[0, 0] + factor[0, 1] * x + factor[1, 0] * o + factor[1, 1] * o * x)
        expected = factor * np.array([[one.sum(), (one * x).sum()], [(one * o).sum(), (one * o * x).sum()]])
        g = seen - expected
        square_factor += g * g
        log_factor = np.clip(log_factor + 0.2 * RATE * g / np.sqrt(square_factor), -4, 4)
    factor, start = np.exp(log_factor), float(np.exp(log_start))
    _, _, p = forward_backward(emissions(weight, bias, buckets), doc, factor, start)
    return Model(weight, float(bias), factor, start, weigh_sums(document_sums(p, doc, len(toxic)), toxic))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, label, text) -> (doc_id, label, buckets of all words, packed)."""
    for batch in batches:
        for lo, data, offsets in pieces(batch.column(2)):
            w, buckets = word_features(data, offsets)
            cut = np.searchsorted(w.doc, np.arange(len(offsets)))
            packed = [np.ascontiguousarray(buckets[:, a:b]).astype("<i4").tobytes() for a, b in zip(cut, cut[1:], strict=False)]
            n = len(packed)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array(packed, pa.binary())], ["doc_id", "label", "buckets"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    sample = labelled_sample(docs, labels, label, folds, held_out, {1: TRAIN_TOXIC, 0: TRAIN_CLEAN})
    rows = sorted(sample.mapInArrow(_featured, "doc_id long, label int, buckets binary").collect(), key=lambda r: (r["doc_id"], bytes(r["buckets"])))
    toxic = np.array([r["label"] == 1 for r in rows], bool)
    length = [len(r["buckets"]) // 12 for r in rows]
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), length)
    buckets = np.empty((3, len(doc)), np.int32)
    for r, at, n in zip(rows, np.cumsum([0, *length]).tolist(), length, strict=False):
        buckets[:, at:at + n] = np.frombuffer(r["buckets"], "<i4").reshape(3, -1)
    del rows
    return train(doc, toxic, buckets)


def spans(p: np.ndarray, w, offsets: np.ndarray, data: np.ndarray) -> list[list[tuple[int, int]]]:
    """Offending (start, stop) of every document in code points: runs of words with a marginal of SPAN_AT or more."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(offsets) - 1)]
    hot = np.flatnonzero(p >= SPAN_AT)
    if len(hot) == 0:
        return out
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    for i in hot.tolist():
        d = int(w.doc[i])
        base = points[offsets[d]]
        start, stop = int(points[w.start[i]] - base), int(points[w.stop[i]] - base)
        if out[d] and i and w.doc[i - 1] == d and p[i - 1] >= SPAN_AT:
            out[d][-1] = (out[d][-1][0], stop)
        else:
            out[d].append((start, stop))
    return out


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, score, spans (start, stop) of toxic words in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            for lo, data, offsets in pieces(batch.column(1)):
                n = len(offsets) - 1
                w, buckets = word_features(data, offsets)
                _, _, p = forward_backward(emissions(m.weight, m.bias, buckets), w.doc, m.factor, m.start)
                found = [[{"start": a, "stop": b} for a, b in s] for s in spans(p, w, offsets, data)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.array(document_scores(p, w.doc, n, m.document)), pa.array(found, kind)],
                                                 ["doc_id", "score", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, spans array<struct<start:int,stop:int>>")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, spans."""
    tagged = tag(docs, fit(docs, labels))
    return tagged.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
