"""Vector code compression: product codes with an equal-average search.

Vectors of integer components floor(SCALE * x) are cut into PARTS equal
consecutive parts.  Every part position has a codebook of ENTRIES entries, which
starts as that part of the vectors with the smallest ids and is moved ROUNDS
times to the floored means of the parts that it serves.

The nearest entry is found by an equal-average search.  A codebook's entries are
sorted by their component sums.  From the place of a part's own sum the search
goes outward, the nearer sum first.  The squared gap of two sums over the
dimension is never more than the squared distance, so the search of a part ends
where that bound is strictly more than its best distance; an equal bound is still
looked at, since ties go to the lower index.

Each round is one scan: tasks read vectors and hand in one row of counts and
component sums for each position and entry (PARTS x ENTRIES rows of a task), and
the codebooks that go back to the tasks are of that fixed size.  The codes are
made in one more scan.

Defined results: rows whose vector is null or holds null or non-finite components
are dropped.  Vectors count as filled up with zeros to the longest kept length,
rounded up to whole parts.  Null ids come after all others as first entries; equal
ids go by their components.  Fewer kept rows than ENTRIES give that many entries.
Repeated rows count singly, in the output too.  Components are exact up to a
bound that keeps every distance in 64 bits (2 ** 27 at 64 components); larger
ones are an error.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.common import ready, splittable
from tremorlake.session import broadcast_checked

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors that are worked on at once.
BLOCK_ROWS = 8192
_NO_ENTRY = np.iinfo(np.int64).max


def kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), "embedding").filter(
        F.col("embedding").isNotNull()).filter(~bad)


def integers(lists: pa.Array, width: int, scale: int = SCALE) -> np.ndarray:
    """One row of ``width`` integers for each vector."""
    length = np.diff(lists.offsets.to_numpy())
    flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    bound = largest_component(width)
    if len(flat) and np.abs(flat).max() > bound:
        raise ValueError(f"a component of more than {bound} units: distances would not fit 64 bits")
    out = np.zeros((len(lists), width), np.int64)
    out[np.repeat(np.arange(len(lists)), length), np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    return out


def largest_component(width: int) -> int:
    """Units up to which width * (2 u) ** 2 (a whole distance) and (width * 2 u) ** 2 over parts (a sum gap) fit 63 bits."""
    u = 1 << 29
    while width * 4 * u * u >= 1 << 63 or (-(-width // PARTS) * 2 * u) ** 2 >= 1 << 63:
        u >>= 1
    return u


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index, squared distance) of each part's nearest entry, ties to the lower index, and how many distances were computed."""
    n, dim = parts.shape
    sums = entries.sum(1)
    order = np.argsort(sums, kind="stable")
    sums, many = sums[order], len(order)
    own = parts.sum(1)
    high = np.searchsorted(sums, own)
    low = high - 1
    best, index = np.full(n, _NO_ENTRY), np.full(n, _NO_ENTRY)
    going, computed = np.arange(n), 0
    while len(going):
        below, above, mine = low[going], high[going], own[going]
        gap_below = np.where(below >= 0, mine - sums[np.maximum(below, 0)], _NO_ENTRY)
        gap_above = np.where(above < many, sums[np.minimum(above, many - 1)] - mine, _NO_ENTRY)
        down = gap_below <= gap_above
        gap = np.where(down, gap_below, gap_above)
        there = gap < _NO_ENTRY
        # Strictly more than the best distance: gap ** 2 / dim > best, in integers.
        first = best[going] == _NO_ENTRY
        short = np.where(there, gap, 0)
        on = there & (first | (short * short <= np.where(first, 0, best[going]) * dim))
        going, down, at = going[on], down[on], np.where(down, below, above)[on]
        if not len(going):
            break
        entry = order[at]
        distance = np.square(parts[going] - entries[entry]).sum(1)
        computed += len(going)
        better = (distance < best[going]) | ((distance == best[going]) & (entry < index[going]))
        best[going[better]], index[going[better]] = distance[better], entry[better]
        low[going[down]] -= 1
        high[going[~down]] += 1
    return index, best, computed


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(at, BLOCK_ROWS)


def _served(batches: Iterator[pa.RecordBatch], books: np.ndarray, scale: int) -> Iterator[pa.RecordBatch]:
    """(part, entry, count, sums) of a task: what each entry serves."""
    n_parts, n_entries, dim = books.shape
    count, sums = np.zeros((n_parts, n_entries), np.int64), np.zeros((n_parts, n_entries, dim), np.int64)
    for batch in _blocks(batches):
        x = integers(batch.column(0), n_parts * dim, scale).reshape(-1, n_parts, dim)
        for p in range(n_parts):
            index, _, _ = nearest(x[:, p], books[p])
            count[p] += np.bincount(index, minlength=n_entries)
            np.add.at(sums[p], index, x[:, p])
    part, entry = np.nonzero(count)
    yield pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))],
        ["part", "entry", "count", "sums"])


def _coded(batches: Iterator[pa.RecordBatch], books: np.ndarray, scale: int) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, embedding) -> (vec_id, label, code, error)."""
    n_parts, _, dim = books.shape
    for batch in _blocks(batches):
        x = integers(batch.column(2), n_parts * dim, scale).reshape(-1, n_parts, dim)
        code, error = np.zeros((len(x), n_parts), np.int64), np.zeros(len(x), np.int64)
        for p in range(n_parts):
            code[:, p], distance, _ = nearest(x[:, p], books[p])
            error += distance
        written = ["".join(f"{i:02x}" for i in row) for row in code.tolist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(written, pa.string()), pa.array(error)],
                                         ["vec_id", "label", "code", "error"])


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray | None:
    """Codebooks (part, entry, component) of kept rows; None without rows."""
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return None
    dim = max(1, -(-longest // parts))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    seeds = integers(pa.array([r["embedding"] for r in first], pa.list_(pa.float64())), parts * dim, scale)
    books = np.ascontiguousarray(seeds.reshape(len(first), parts, dim).transpose(1, 0, 2))
    for _ in range(rounds):
        found = rows.select("embedding").mapInArrow(_with(_served, books, scale), "part int, entry int, count long, sums array<long>")
        total = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dim)]
        for r in found.groupBy("part", "entry").agg(F.sum("count").alias("count"), *total).collect():
            books[r["part"], r["entry"]] = [r[f"s{i}"] // r["count"] for i in range(dim)]
    return books


def _with(fn, books: np.ndarray, scale: int):
    books = books.copy()  # a task that runs again reads the books of its own round
    return lambda batches: fn(batches, books, scale)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error) of kept rows."""
    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(_with(_coded, books, scale), f"vec_id long, label {kind}, code string, error long")


def compress(vectors: DataFrame) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256."""
    spark = ready(vectors.sparkSession)
    rows = kept(vectors)
    books = train(rows)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = encode(rows, books).checkpoint()
    by_label = broadcast_checked(splittable(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
