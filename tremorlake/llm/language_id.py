"""Language ID: word-first backoff.

A word is a run of letters (and marks after them), lower-cased.  A word that was
learned adds the log10 of its relative frequency in each language; a language
that never had it adds -PENALTY.  A word that was not learned falls back to its
character n-grams, blanks at its ends included: the longest ones first, and where
none of that length was learned, ever shorter ones.  It adds the mean over the
learned n-grams of that length, or -PENALTY for all languages where there is none.  A
text's score in a language is the mean over its words; the best language wins,
ties going to the one with more learned words and then to the smaller name.

Frequencies are learned from a bounded labelled sample: at most TRAIN_ROWS rows
of each language, the first by hash of doc_id, and of each language and length
the most frequent entries, ENTRIES // (languages x lengths) of them.  So the
model, which is broadcast, has at most ENTRIES numbers.  Every text is scored
whole, in the tasks that read it; nothing is shuffled.

Rows of the held-out fold are never learned from.  lang, source and doc_id are no
inputs of a prediction.

Defined results: null texts and texts without a letter are `und` with score 0.
Rows without a doc_id, a lang or a text are not learned from.  Without learned
languages every text is `und`.  Rows that are repeated get equal predictions.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.llm.common import ready
from tremorlake.llm.training import fold

FOLDS, HELD_OUT = 4, 2
NO_LANGUAGE = "und"
#: At most so many labelled rows of each language are learned from.
TRAIN_ROWS = 1000
RANGE_BITS = 14
#: Numbers of the model: (language, length, entry) triples.
ENTRIES = 240_000
#: Length of the longest n-grams; length 0 stands for whole words.
LONGEST = 5
PENALTY = 7.0
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Characters from which on a text's words are counted one by one, and a word is not kept in a cache.
LONG_TEXT, LONG_WORD = 1 << 20, 64
#: Bytes of scores of cached words, and words that are looked up at once.
CACHE_BYTES, WORDS_AT_ONCE = 16 << 20, 50_000
FLUSH = 200_000


def word_counts(text: str) -> Counter:
    low = text.lower()
    if len(low) < LONG_TEXT:
        return Counter(WORD.findall(low))
    return Counter(m.group() for m in WORD.finditer(low))


def grams(word: str, n: int) -> Iterator[str]:
    padded = f" {word} "
    return (padded[i:i + n] for i in range(len(padded) - n + 1))


# --- learning --------------------------------------------------------------------------------

def sample(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, rows: int = TRAIN_ROWS) -> DataFrame:
    """(lang, text) of at most ``rows`` training rows of each language.

    Rows are picked by ids alone, from the lowest of 2 ** RANGE_BITS ranges of
    hashes, so that few more than ``rows`` of a language are sorted, however many
    tasks read them; the picked ids are broadcast to the scan of the texts.
    """
    ready(docs.sparkSession)
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & (fold("doc_id", folds) != held_out))
    # The ranges of hashes that hold a language's first rows, from counts by range: only their rows meet in the window.
    known = known.withColumn("range", F.shiftrightunsigned(F.xxhash64("doc_id").bitwiseXOR(F.lit(-1 << 63)), 64 - RANGE_BITS))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("range")) - F.col("n")
    low = known.groupBy("lang", "range").agg(F.count(F.lit(1)).alias("n")).withColumn("before", upto).filter(F.col("before") < rows)
    known = known.join(F.broadcast(low.groupBy("lang").agg(F.max("range").alias("last"))), "lang").filter(F.col("range") <= F.col("last"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    picked = known.withColumn("nth", first).filter(F.col("nth") <= rows).select("doc_id", "lang").distinct().checkpoint()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").filter(F.col("text").isNotNull())
    texts = texts.join(F.broadcast(picked), ["doc_id", "lang"])
    # A doc_id may stand on any number of rows: the bound is on rows.
    again = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")))
    return texts.withColumn("nth", again).filter(F.col("nth") <= rows).select("lang", "text")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, n, entry, count) of a task's words (n = 0) and n-grams."""
    counts: Counter = Counter()

    def made():
        keys = list(counts)
        batch = pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([k[2] for k in keys], pa.string()), pa.array([counts[k] for k in keys], pa.int64())], ["lang", "n", "entry", "count"])
        counts.clear()
        return batch

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            lang = lang.as_py()
            for word, many in word_counts(text.as_py()).items():
                counts[lang, 0, word] += many
                for n in range(1, LONGEST + 1):
                    for gram in grams(word, n):
                        counts[lang, n, gram] += many
                if len(counts) >= FLUSH:
                    yield made()
    yield made()


class Model(NamedTuple):
    """Languages, a place for each entry of each length, and by place the languages and log10 frequencies (in compressed rows)."""

    languages: list[str]
    places: list[dict[str, int]]
    start: np.ndarray
    language: np.ndarray
    value: np.ndarray


def fit(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, rows: int = TRAIN_ROWS, entries: int = ENTRIES) -> Model:
    counted = sample(docs, folds, held_out, rows).mapInArrow(_counted, "lang string, n int, entry string, count long")
    totals = counted.groupBy("lang", "n", "entry").agg(F.sum("count").alias("count")).checkpoint()
    sums = {(r["lang"], r["n"]): r["total"] for r in totals.groupBy("lang", "n").agg(F.sum("count").alias("total")).collect()}
    # More learned words first: the order in which ties are settled.
    languages = sorted({lang for lang, _ in sums}, key=lambda lang: (-sums[lang, 0], lang.encode()))
    most = max(1, entries // max(1, len(languages) * (LONGEST + 1)))
    frequent = F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("count"), "entry"))
    kept = totals.withColumn("nth", frequent).filter(F.col("nth") <= most).drop("nth").toArrow().sort_by([("n", "ascending"), ("entry", "ascending"), ("lang", "ascending")])
    number = {lang: i for i, lang in enumerate(languages)}
    places: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    start, language, value = [], [], []
    for lang, n, entry, count in zip(*(kept.column(c).to_pylist() for c in ("lang", "n", "entry", "count")), strict=True):
        if entry not in places[n]:
            places[n][entry] = len(start)
            start.append(len(language))
        language.append(number[lang])
        value.append(np.log10(count / sums[lang, n]))
    return Model(languages, places, np.array([*start, len(language)], np.int64), np.array(language, np.int32), np.array(value, np.float64))


# --- scoring -----------------------------------------------------------------------------------

class Scorer:
    """Scores of words, kept in a cache of bounded size."""

    def __init__(self, model: Model):
        self.model = model
        self.width = max(1, len(model.languages))
        self.rows = max(1024, CACHE_BYTES // (8 * self.width))
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.score = np.zeros((1024, self.width))

    def entries(self, word: str) -> list[int]:
        """Places of what stands for a word: itself, or its learned n-grams of the longest length that has any."""
        places = self.model.places
        if word in places[0]:
            return [places[0][word]]
        for n in range(LONGEST, 0, -1):
            found = [places[n][g] for g in grams(word, n) if g in places[n]]
            if found:
                return found
        return []

    def learn(self, words: list[str]) -> None:
        """Rows of scores for new words."""
        first = len(self.row) - len(words)
        while len(self.row) > len(self.score):
            self.score = np.concatenate([self.score, np.zeros_like(self.score)])
        self.score[first:len(self.row)] = -PENALTY
        found = [self.entries(w) for w in words]
        many = np.array([len(f) for f in found])
        place = np.array([p for f in found for p in f], np.int64)
        if not len(place):
            return
        of, share = np.repeat(np.arange(len(words)), many), np.repeat(1 / np.maximum(1, many), many)
        start, length = self.model.start[place], self.model.start[place + 1] - self.model.start[place]
        at = np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())
        cell = np.repeat(of, length) * self.width + self.model.language[at]
        # What a language has of an entry, in place of the penalty for it.
        added = np.bincount(cell, weights=(self.model.value[at] + PENALTY) * np.repeat(share, length), minlength=len(words) * self.width)
        self.score[first:len(self.row)] += added.reshape(len(words), self.width)

    def predict(self, texts: Iterator[str | None]) -> Iterator[tuple[list[str], np.ndarray]]:
        """(languages, scores) of runs of texts; a score is the winner's share of 10 ** (mean log10 score)."""
        held: list[Counter] = []
        pending = 0
        for text in texts:
            held.append(word_counts(text) if text and self.model.languages else Counter())
            pending += len(held[-1])
            if pending >= WORDS_AT_ONCE:
                yield self._run(held)
                held, pending = [], 0
        if held:
            yield self._run(held)

    def _run(self, held: list[Counter]) -> tuple[list[str], np.ndarray]:
        if len(self.row) >= self.rows:
            self.clear()
        row, new, rows = self.row, [], []
        for counts in held:
            for word in counts:
                at = row.get(word)
                if at is None:
                    at = row[word] = len(row)
                    new.append(word)
                rows.append(at)
        if new:
            self.learn(new)
        many = np.array([len(c) for c in held])
        weight = np.array([n for c in held for n in c.values()], np.float64)
        total, words = np.full((len(held), self.width), -np.inf), np.zeros(len(held))
        some = many > 0
        if some.any():
            begin = (np.cumsum(many) - many)[some]
            words[some] = np.add.reduceat(weight, begin)
            for k in range(self.width):
                total[some, k] = np.add.reduceat(self.score[rows, k] * weight, begin) / words[some]
        best = total.argmax(1)
        share = np.zeros(len(held))
        share[some] = 1 / np.power(10.0, total[some] - total[some, best[some]][:, None]).sum(1)
        if any(len(w) > LONG_WORD for w in new):  # long words would fill the cache
            self.clear()
        return [self.model.languages[b] if s else NO_LANGUAGE for b, s in zip(best, some, strict=True)], share


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    shared = ready(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            at = 0
            for languages, score in scorer.predict(t.as_py() for t in batch.column(1)):
                n = len(languages)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), pa.array(languages, pa.string()), pa.array(score, pa.float64())],
                                                 ["doc_id", "lang_pred", "score"])
                at += n

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def classify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score; learned from its rows outside the held-out fold."""
    return identify(docs, fit(docs)).select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")
