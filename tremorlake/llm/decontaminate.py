"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit distance.

Symbols are words (A-Z lower-cased), so white space, punctuation and case don't
count.  The CGK embedding reads a string by a random walk: at step j it writes
the symbol at its place and moves on, or stays, as a hash of the symbol and j
says.  Strings within a small edit distance fall into step again, so their
embeddings differ in few coordinates.

The walk is started at every word of every item and of every text, so the
coordinates that are sampled lie all over an item-sized window.  A repetition
samples some of its steps as a key.  Steps, samples and repetitions go by classes
of item length (WALKS); the repetitions of a class are the fewest with which, in
a seeded simulation at the class's shortest length and with all edits allowed,
TARGET_RECALL of the places share a key.  Walks alone reach 0.9 at every length
(tested).  For the rest every item is also cut into one part more than the edits
it allows.  An edit touches one part at most, so one part of every place stands
unedited; the parts' keys find it for certain, whatever the item's length.

Keys of a text's words that stand in the items' key tables give an item and a
diagonal; the window on that diagonal, wider by the allowed edits, is verified
by the exact edit distance over words: at most MAX_EDITS of the item's words.

Items are read in blocks of at most BLOCK_WORDS words, and key tables are sized by
their keys, so what is broadcast has a fixed bound; texts are scanned once for
each block, and with several blocks each one's result is checkpointed and its
broadcast ended before the next.

Defined results: null or empty texts contain nothing; null or empty items match
nothing.  Items of fewer than EXACT_BELOW words allow no edit: they count where
they stand exactly.
Repeated rows give repeated pairs, repeated items one pair for each row.  An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.common import ready, shielding
from tremorlake.llm.text_arrays import Words, mix, pieces, word_hashes, words

MAX_EDITS = 0.2
#: Items from so many words on allow an edit.
EXACT_BELOW = 5
#: Steps of the longest walk, and words of the longest part's key.
STEPS = 8
TARGET_RECALL = 0.97
BLOCK_WORDS = 1_000_000


class Walk(NamedTuple):
    """Walks for items of ``shortest`` words and more: ``sampled`` of ``steps`` steps, on ``distinct`` places at least."""

    shortest: int
    steps: int
    sampled: int
    distinct: int


WALKS = (Walk(5, 6, 3, 3), Walk(8, 8, 4, 3), Walk(15, 8, 5, 4), Walk(25, 8, 5, 4))


class Items(NamedTuple):
    """A block of items: word hashes one after another, for each walk and repetition the sorted keys with item and place, and the same for parts by their length."""

    ids: np.ndarray
    begin: np.ndarray
    word: np.ndarray
    keys: list[tuple[Walk, int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]
    short: dict[int, list[tuple[np.ndarray, np.ndarray]]]
    parts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def coordinates(repetition: int, walk: Walk) -> list[int]:
    """The sampled steps of a repetition, by its random numbers."""
    rng = np.random.default_rng(1000 + repetition)
    return sorted(rng.choice(walk.steps, walk.sampled, replace=False).tolist())


def walk_keys(word: np.ndarray, n: int, repetition: int, walk: Walk = WALKS[-1]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key of the walk from each of the first n words, whether it is used, and the last place that it sampled; word is longer by at least STEPS words.

    A walk that hardly moved says little: its samples must lie on walk.distinct places at least.
    Whether they do follows from the words alone, so it is the same for items and texts.
    """
    bits = mix(word ^ np.uint64(0x51ED270B * (repetition + 1)))
    at, key, sampled = np.arange(n), np.full(n, walk.shortest << 16 | repetition + 1, np.uint64), coordinates(repetition, walk)
    seen, before = np.zeros(n, np.int8), np.full(n, -1)
    for j in range(sampled[-1] + 1):
        if j in sampled:
            key *= np.uint64(0x9E3779B97F4A7C15)
            key ^= word[at]
            seen += at != before
            before = at.copy()
        if j < sampled[-1]:
            at += ((bits[at] >> np.uint64(j)) & np.uint64(1)).astype(np.int64)
    return mix(key), seen >= walk.distinct, at


@cache
def repetitions(walk: Walk, max_edits: float = MAX_EDITS, target: float = TARGET_RECALL, trials: int = 1000) -> int:
    """The fewest repetitions with which ``target`` of edited items of the class's shortest length share a key with the original."""
    rng = np.random.default_rng(walk.shortest)
    n, wide = walk.shortest, walk.shortest + STEPS + 1
    word = rng.integers(1, 1 << 62, (trials, wide), dtype=np.uint64)
    edited = word.copy()
    changed = rng.random((trials, n)).argsort(1)[:, :int(np.floor(max_edits * n))]
    np.put_along_axis(edited, changed, rng.integers(1, 1 << 62, changed.shape, dtype=np.uint64), 1)
    pad = np.zeros(STEPS + 1, np.uint64)
    start = np.arange(trials * wide)
    hit, r = np.zeros(trials, bool), 0
    while hit.mean() < target:
        (a, used, last), (b, _, _) = (walk_keys(np.concatenate([w.ravel(), pad]), trials * wide, r, walk) for w in (word, edited))
        inside = (start % wide < n) & (last - start + start % wide < n)
        hit |= ((a == b) & used & inside).reshape(trials, wide).any(1)
        r += 1
    return r


def run_keys(word: np.ndarray, n: int, length: int) -> np.ndarray:
    """Key of the next ``length`` words from each of the first n."""
    key = np.full(n, length, np.uint64)
    for j in range(length):
        key *= np.uint64(0x9E3779B97F4A7C15)
        key ^= word[j:j + n]
    return mix(key)


def _table(keys: np.ndarray, item: np.ndarray, place: np.ndarray):
    """Sorted keys, and before them a table of about 16 to 32 bits of a key for each that says at once that a key is none of an item's."""
    order = np.argsort(keys, kind="stable")
    known = np.zeros(1 << max(10, (16 * len(keys)).bit_length()), bool)
    known[_slot(keys, known)] = True
    return known, keys[order], item[order], place[order]


def _slot(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(65 - len(known).bit_length())


def cut_in_parts(size: int, edits: int) -> list[tuple[int, int]]:
    """(first word, words) of the parts of an item, of which one stands unedited after ``edits`` edits; keys take STEPS words of a part at most."""
    n = min(edits + 1, size)
    at = [k * size // n for k in range(n + 1)]
    return [(a, min(b - a, STEPS)) for a, b in zip(at, at[1:], strict=False)]


def index_items(rows: list[tuple[int, str]], max_edits: float = MAX_EDITS) -> Items:
    hashes = [word_hashes(text or "") for _, text in rows]
    begin = np.cumsum([0] + [len(h) for h in hashes])
    word = np.concatenate([*hashes, np.zeros(STEPS + 1, np.uint64)]) if rows else np.zeros(STEPS + 1, np.uint64)
    item = np.repeat(np.arange(len(rows)), np.diff(begin))
    place = np.arange(begin[-1]) - begin[item] if len(item) else np.zeros(0, np.int64)
    size = np.diff(begin)
    keys = []
    for walk, longer in zip(WALKS, [w.shortest for w in WALKS[1:]] + [np.inf], strict=True):
        mine = (size[item] >= walk.shortest) & (size[item] < longer) if len(item) else np.zeros(0, bool)
        for r in range(repetitions(walk, max_edits) if mine.any() else 0):
            k, used, last = walk_keys(word, int(begin[-1]), r, walk)
            used &= mine & (last < begin[item + 1])
            keys.append((walk, r, _table(k[used], item[used], place[used])))
    short: dict[int, list] = {}
    for length in range(1, EXACT_BELOW):
        few = np.flatnonzero(size == length)
        if len(few):
            k = run_keys(word, int(begin[-1]), length)[begin[few]]
            short[length] = _table(k, few, np.zeros(len(few), np.int64))
    by_length: dict[int, list[tuple[int, int]]] = {}
    for t, many in enumerate(size.tolist()):
        for a, length in cut_in_parts(many, int(np.floor(max_edits * many))) if many >= EXACT_BELOW else []:
            by_length.setdefault(length, []).append((t, a))
    parts = {}
    for length, places in by_length.items():
        t, a = np.array(places, np.int64).T
        parts[length] = _table(run_keys(word, int(begin[-1]), length)[begin[t] + a], t, a)
    return Items(np.array([i for i, _ in rows], np.int64), begin, word, keys, short, parts)


def lookup(key: np.ndarray, table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in ``key``, item, place in the item) of every equal key."""
    known, keys, item, place = table
    at = np.flatnonzero(known[_slot(key, known)])
    lo, hi = np.searchsorted(keys, key[at], "left"), np.searchsorted(keys, key[at], "right")
    n = hi - lo
    entry = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]] if len(n) else lo, n) + np.arange(int(n.sum()))
    return np.repeat(at, n), item[entry], place[entry]


def edit_distance_within(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """(distance, begin, end) of the part of ``window`` that is nearest to ``item`` by word edits."""
    m = len(window)
    step = np.arange(m + 1)
    row, origin = np.zeros(m + 1, np.int64), step.copy()
    for i, symbol in enumerate(item):
        change, drop = row[:-1] + (window != symbol), row[1:] + 1
        take = change <= drop
        best = np.concatenate([[i + 1], np.where(take, change, drop)])
        source = np.concatenate([[0], np.where(take, origin[:-1], origin[1:])])
        # Words put in: the best of all earlier places plus the words between.
        level = best - step
        low = np.minimum.accumulate(level)
        from_ = np.maximum.accumulate(np.where(level == low, step, 0))
        row, origin = low + step, source[from_]
    end = int(row.argmin())
    return int(row[end]), int(origin[end]), end


def find(w: Words, offsets: np.ndarray, items: Items, max_edits: float = MAX_EDITS) -> list[tuple[int, int, int, int, int]]:
    """(document, item, first word, last word + 1, distance), the nearest place of each item in each document; words by place in the piece."""
    n = len(w.hash)
    cut = np.searchsorted(w.doc, np.arange(len(offsets)))
    padded = np.concatenate([w.hash, np.zeros(STEPS + 1, np.uint64)])
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for length, table in items.short.items():
        at, item, _ = lookup(run_keys(padded, n, length), table)
        for p, t in zip(at.tolist(), item.tolist(), strict=True):
            d, b = int(w.doc[p]), int(items.begin[t])
            if p + length <= cut[d + 1] and (padded[p:p + length] == items.word[b:b + length]).all():
                found.setdefault((d, t), (0, p, p + length))
    hits = []
    for walk, r, table in items.keys if n else ():
        key, used, _ = walk_keys(padded, n, r, walk)
        used = np.flatnonzero(used & table[0][_slot(key, table[0])])
        at, item, place = lookup(key[used], table)
        hits.append((used[at], item, place))
    for length, table in items.parts.items() if n else ():
        at, item, place = lookup(run_keys(padded, n, length), table)
        # A run must not go on into the next text.
        own = w.doc[np.minimum(at + length - 1, n - 1)] == w.doc[at]
        own &= at + length <= n
        hits.append((at[own], item[own], place[own]))
    if hits:
        at, item, place = (np.concatenate(x) for x in zip(*hits, strict=True))
    if hits and len(at):
        doc, diagonal = w.doc[at], at - place
        order = np.lexsort((diagonal, item, doc))
        doc, item, diagonal = doc[order], item[order], diagonal[order]
        size = np.diff(items.begin)[item]
        edits = np.floor(max_edits * size).astype(np.int64)
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > 2 * edits[1:] + 1)
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(doc)] - 1
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            d, t, e = int(doc[a]), int(item[a]), int(edits[a])
            lo, hi = max(int(cut[d]), int(diagonal[a]) - e), min(int(cut[d + 1]), int(diagonal[b]) + int(size[a]) + e)
            target, window = items.word[items.begin[t]:items.begin[t + 1]], w.hash[lo:hi]
            # Every edit loses one of the item's words at most.
            if np.isin(target, window).sum() < size[a] - e:
                continue
            distance, begin, end = edit_distance_within(target, window)
            if distance <= e and distance < found.get((d, t), (e + 1, 0, 0))[0]:
                found[d, t] = distance, lo + begin, lo + end
    return [(d, t, b, e, x) for (d, t), (x, b, e) in sorted(found.items())]


def _scan(docs: DataFrame, items: Items, max_edits: float) -> tuple[DataFrame, Broadcast]:
    shared = ready(docs.sparkSession).sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for lo, data, offsets in pieces(batch.column(1)):
                w = words(data, offsets)
                rows = find(w, offsets, block, max_edits)
                ids = batch.column(0).slice(lo, len(offsets) - 1).to_pylist()
                out = [[] for _ in range(6)]
                for d, t, b, e, x in rows:
                    def points(at, d=d):
                        return len(bytes(data[offsets[d]:at]).decode())
                    values = ids[d], int(block.ids[t]), points(w.start[b]) if e > b else 0, points(w.stop[e - 1]) if e > b else 0, x, int(block.begin[t + 1] - block.begin[t])
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()], strict=True)],
                                                 ["doc_id", "item_id", "start", "stop", "edits", "item_words"])

    return docs.mapInArrow(run, "doc_id long, item_id long, start int, stop int, edits int, item_words int"), shared


def contaminated(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each text and item that it contains: doc_id, item_id, start and stop in code points, edits, item_words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    items = benchmark.filter(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    # A word has at least one character and one that parts it, so the length bounds the words.
    total = items.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    n_blocks = int(total // (2 * block_words)) + 1
    out = None
    for k in range(n_blocks):
        part = items if n_blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == k)
        block = index_items(sorted((r["item_id"], r["text"]) for r in part.collect()), max_edits)
        found, shared = _scan(rows, block, max_edits)
        if n_blocks > 1:  # one block's tables at a time
            found = found.checkpoint()
            shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out


@shielding
def keep_clean(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS) -> DataFrame:
    """The documents, with all their columns, that contain no item.

    Rows with a null doc_id are held against the items by a hash of their text.
    """
    known = F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long")), F.coalesce("text", F.lit("")))
    found = contaminated(docs.select(known.alias("doc_id"), "text"), benchmark, max_edits).select(F.col("doc_id").alias("__row")).distinct()
    return docs.join(found, known == F.col("__row"), "left_anti")
