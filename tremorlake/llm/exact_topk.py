"""Exact top-k search by a uniform threshold in three phases.

A score is an integer inner product.  The components are cut into SEGMENTS; the
partial scores of one query, one block of rows and one segment are a list.

1. Every block gives, for each query, the rows at the head of its lists with
   their scores.  The k-th best of all gathered scores is a safe cutoff t: at
   least k rows reach it.
2. The cutoffs go to all blocks.  A score of t or more needs a partial score of
   t / SEGMENTS or more in some list, so each list hands in the entries from
   that uniform threshold on.
3. Only these get their exact score; those that reach t are ranked.

Lists hold every partial score, so steps 1 and 2 both multiply all vectors; the
segments are added up at the heads and above the threshold alone.

Queries and rows are hashed to blocks of at most 8,192 vectors and 2^21 components,
and every query block meets every row block once, so no task and no broadcast
grows with the data.  Within a block TILE queries are worked on at a time.

Defined results: vectors that are null or hold null or non-finite components,
and rows without an id, take no part.  Rows with the query's id are its own.
Shorter vectors count as filled up with zeros.  Repeated candidate rows count
singly; a query id that is repeated is asked once, by its smallest vector.
Without other rows a query has no result.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.llm.common import ready
from tremorlake.llm.grouping import grouped

K = 20
EVERY = 20
SCALE = 64
SEGMENTS = 2
QUERY_BLOCK, ROW_BLOCK = 8192, 8192
BLOCK_COMPONENTS = 1 << 21
TILE = 512
NO_CUTOFF = -(1 << 62)
_AT = ["qb", "cb"]
_LOWEST = {"f": -np.inf, "i": np.iinfo(np.int64).min}


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) of the rows that take part: v holds floor(scale * component)."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(~bad)
    return rows.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    length = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    out[np.repeat(np.arange(len(lists)), length), np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _width(table: pa.Table) -> int:
    lists = pa.concat_arrays(table.column("v").chunks)
    return max(1, int(np.diff(lists.offsets.to_numpy()).max()))


def partial_scores(q: np.ndarray, c: np.ndarray, segments: int) -> list[np.ndarray]:
    """Score matrices of each segment; exact, by integers where floating point would not be."""
    cuts = np.linspace(0, q.shape[1], segments + 1).astype(int)
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    kind = np.float32 if largest < 2 ** 24 else np.float64 if largest < 2 ** 53 else np.int64
    q, c = q.astype(kind), c.astype(kind)
    return [q[:, a:b] @ c[:, a:b].T for a, b in zip(cuts, cuts[1:], strict=False)]


def _tiles(table: pa.Table, segments: int):
    """(query ids, row ids, score matrices of the segments, cutoffs) of TILE queries at a time."""
    is_query, ids = table.column("is_query").to_numpy(), table.column("vec_id").to_numpy()
    q, c = np.flatnonzero(is_query), np.flatnonzero(~is_query)
    if len(q) == 0 or len(c) == 0:
        return
    v, cutoff = _matrix(table.column("v"), _width(table)), table.column("cutoff").to_numpy()
    rows = v[c]
    for lo in range(0, len(q), TILE):
        some = q[lo:lo + TILE]
        yield ids[some], ids[c], partial_scores(v[some], rows, segments), cutoff[some]


def exact_scores(parts: list[np.ndarray], i: int, at: np.ndarray) -> np.ndarray:
    """Scores of query i and the rows ``at``, added up from the segments."""
    return sum(p[i, at].astype(np.int64) for p in parts)


def _heads(batches: Iterator[pa.RecordBatch], k: int, segments: int) -> Iterator[pa.RecordBatch]:
    """Phase 1: (query_id, score) of the best k of the rows at the heads of a block's lists."""
    for table in grouped(batches, _AT):
        for q_ids, c_ids, parts, _ in _tiles(table, segments):
            query, score = [], []
            for i, q in enumerate(q_ids):
                other = c_ids != q
                heads = np.unique(np.concatenate([_top(np.where(other, p[i], _LOWEST[p.dtype.kind]), k) for p in parts]))
                best = np.sort(exact_scores(parts, i, heads[other[heads]]))[::-1][:k]
                query.append(np.full(len(best), q))
                score.append(best)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(query)), pa.array(np.concatenate(score))], ["query_id", "score"])


def _top(x: np.ndarray, k: int) -> np.ndarray:
    return np.arange(len(x)) if len(x) <= k else np.argpartition(x, len(x) - k)[len(x) - k:]


def _above(batches: Iterator[pa.RecordBatch], k: int, segments: int) -> Iterator[pa.RecordBatch]:
    """Phases 2 and 3: the entries from the uniform threshold on, scored; of a block no more than its best k of a query count."""
    for table in grouped(batches, _AT):
        for q_ids, c_ids, parts, cutoff in _tiles(table, segments):
            least = -(-cutoff // segments)
            out = [[], [], []]
            for i, q in enumerate(q_ids):
                entry = np.zeros(len(c_ids), bool)
                for p in parts:
                    entry |= p[i] >= least[i]
                entry = np.flatnonzero(entry & (c_ids != q))
                score = exact_scores(parts, i, entry)
                entry, score = entry[score >= cutoff[i]], score[score >= cutoff[i]]
                order = np.lexsort((c_ids[entry], -score))[:k]
                for column, x in zip(out, (np.full(len(order), q), c_ids[entry[order]], score[order]), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["query_id", "vec_id", "score"])


def _met(queries: DataFrame, rows: DataFrame, n_q: int, n_c: int) -> DataFrame:
    """Every query block beside every row block: (qb, cb, is_query, vec_id, cutoff, v), placed and sorted."""
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.select(block(n_q).alias("qb"), every(n_c).alias("cb"), F.lit(True).alias("is_query"), "vec_id", "cutoff", "v")
    stored = rows.select(every(n_q).alias("qb"), block(n_c).alias("cb"), F.lit(False).alias("is_query"), "vec_id", F.lit(0).cast("long").alias("cutoff"), "v")
    return asked.unionByName(stored).repartition(*_AT).sortWithinPartitions(*_AT)


def search(queries: DataFrame, rows: DataFrame, k: int = K, segments: int = SEGMENTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of each query against all other rows, ties to the smaller vec_id.

    ``queries`` and ``rows`` hold (vec_id, v).
    """
    ready(queries.sparkSession)
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    n_asked, n_rows = asked.agg(F.count(F.lit(1))).first()[0], rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    fitting = max(1, BLOCK_COMPONENTS // max(1, n_rows[1] or 1))
    n_q, n_c = max(1, -(-n_asked // min(QUERY_BLOCK, fitting))), max(1, -(-n_rows[0] // min(ROW_BLOCK, fitting)))
    heads = _met(asked.withColumn("cutoff", F.lit(NO_CUTOFF)), rows, n_q, n_c).mapInArrow(
        lambda b: _heads(b, k, segments), "query_id long, score long")
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    cutoffs = heads.withColumn("nth", nth).filter(F.col("nth") <= k).groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(NO_CUTOFF).alias("cutoff"))
    with_cutoff = asked.join(cutoffs, asked["vec_id"] == cutoffs["query_id"], "left").select(
        "vec_id", "v", F.coalesce("cutoff", F.lit(NO_CUTOFF)).alias("cutoff"))
    found = _met(with_cutoff, rows, n_q, n_c).mapInArrow(lambda b: _above(b, k, segments), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """The search of every row whose vec_id is divisible by ``every`` against all rows."""
    rows = quantised(vectors)
    return search(rows.filter(F.col("vec_id") % every == 0), rows, k)
