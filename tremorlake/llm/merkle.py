"""Merkle dataset manifest: a SHA midstate tree over rows, by source.

Every row is a leaf, the hash of its fields; per source the leaves stand in the
order of doc_id, and every FAN consecutive nodes become the hash of their
digests, level by level, until one is left: the source's subroot.  The subroots,
in the order of their sources, are the leaves of one more such tree; its root
stands for the table.

A parent keeps copies of its hash state, one from before each child slot: the
states after no child, after one child and so on.  Folding a changed child
resumes the copy of its slot, adds the replacement and the siblings to its right
and is done; siblings to the left are never hashed again.

Trees are built in blocks of FAN ** LEVELS consecutive nodes, so one shuffle makes
LEVELS levels and a source of n rows needs log(n) / log(FAN ** LEVELS) shuffles;
a block is one task's group of bounded size, however many rows a source has.
Then the way back: each block is given the siblings above it (a few hundred bytes
for a block, not for a row), rebuilds its states and hands the siblings on; the
leaves' blocks fold every leaf up to the root.  Positions come from a range
partitioning by source and doc_id, so a source that holds most rows is spread.

Defined results: rows are ordered by source (null first, then bytewise), doc_id
(null first) and leaf, so repeated rows stand beside each other and the tree does
not depend on partitions.  Null fields are `-`.  Rows without a doc_id are never
tampered with.  Without siblings on any level the proof is the hash of nothing.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.common import ready
from tremorlake.llm.grouping import grouped

FAN = 3
#: Levels of one block: 3 ** 7 = 2187 nodes.
LEVELS = 7
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_NODES = "tree long, block long, idx long, digest string"


# --- leaves --------------------------------------------------------------------------------

def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(_field, fields)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, changed): ``changed`` is the leaf of the tampered row, null for rows that are left alone."""
    fields = [F.col(c) for c in FIELDS]
    tampered = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    picked = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf(fields).alias("leaf"),
                       F.when(picked, leaf([*fields[:-1], tampered])).alias("changed"))


# --- positions -----------------------------------------------------------------------------

def positions(rows: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """``columns`` with (tree, idx): the number of a row's key in key order (with gaps), and its place, from 0, among its key's rows.

    The sorted ranges are checkpointed.  Of each range one row goes to the
    driver: its first and last key with their counts.  Only a range's first key
    can go on from the ranges before it, so one offset for each range is enough.
    """
    spark = ready(rows.sparkSession)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (rows.repartitionByRange(n, key, *order).sortWithinPartitions(key, *order)
              .withColumn("pid", F.spark_partition_id()).checkpoint())
    counts = placed.groupBy("pid", key).agg(F.count(F.lit(1)).alias("n"))
    ends = F.struct(F.col(key).alias("key"), F.col("n"))
    facts = sorted(counts.groupBy("pid").agg(F.min(ends).alias("first"), F.max(ends).alias("last"), F.count(F.lit(1)).alias("keys")).collect(),
                   key=lambda r: r["pid"])
    begin, before, tree, done = {}, None, None, 0  # pid -> (tree of its first key, rows of that key in earlier ranges)
    for r in facts:
        pid, first, last = r["pid"], r["first"], r["last"]
        goes_on = before is not None and before[0] == first["key"]
        begin[pid] = (tree, done) if goes_on else (pid << 32, 0)
        if r["keys"] > 1:
            tree, done = (pid << 32) + r["keys"] - 1, last["n"]
        else:
            tree, done = begin[pid][0], begin[pid][1] + last["n"]
        before = (last["key"],)
    at_key, at_pid, at = placed.columns.index(key), placed.columns.index("pid"), [placed.columns.index(c) for c in columns]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = current = tree = None
        idx = ordinal = 0
        for batch in batches:
            trees, places = [], []
            for p, k in zip(batch.column(at_pid).to_pylist(), batch.column(at_key).to_pylist(), strict=True):
                if p != pid:
                    pid, current, ordinal = p, (k,), 0
                    tree, idx = begin[p]
                elif (k,) != current:
                    current, ordinal = (k,), ordinal + 1
                    tree, idx = (p << 32) + ordinal, 0
                trees.append(tree)
                places.append(idx)
                idx += 1
            yield pa.RecordBatch.from_arrays([pa.array(trees, pa.int64()), pa.array(places, pa.int64()), *[batch.column(i) for i in at]],
                                             ["tree", "idx", *columns])

    kinds = ", ".join(f"{c} {placed.schema[c].dataType.simpleString()}" for c in columns)
    return placed.mapInArrow(number, f"tree long, idx long, {kinds}")


# --- blocks ----------------------------------------------------------------------------------

class Parent:
    """The hash of some children's digests, with a copy of the state from before each child slot."""

    def __init__(self, digests: list[str]):
        self.states, self.children = [], [d.encode() for d in digests]
        state = hashlib.sha256()
        for child in self.children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest()

    def fold(self, slot: int, digest: str) -> str:
        """The hash with another digest in a slot: the slot's state resumed, the replacement and what stands right of it added."""
        state = self.states[slot].copy()
        state.update(digest.encode())
        for child in self.children[slot + 1:]:
            state.update(child)
        return state.hexdigest()


def block_levels(digests: list[str], block: int, levels: int = LEVELS) -> list[list[Parent]]:
    """The levels above a block's nodes.

    A block that is not a tree's first has others beside it and takes all its
    levels, even with one node left.  The first block is full if there are
    others, and else ends with the one node that remains: the same rule for both.
    """
    out = []
    while len(out) < levels and (block > 0 or len(digests) > 1):
        out.append([Parent(digests[i:i + FAN]) for i in range(0, len(digests), FAN)])
        digests = [p.digest for p in out[-1]]
    return out


def steps(levels: list[list[Parent]], idx: int) -> Iterator[tuple[Parent, int]]:
    """(parent, child slot) from a block's node up to the block's top."""
    for level in levels:
        yield level[idx // FAN], idx % FAN
        idx //= FAN


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"idx div {FAN ** levels}"))


def _sorted(rows: DataFrame, *more: str) -> DataFrame:
    """A block's rows in one task, in order; ``grouped`` then holds one block at a time."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *more)


def _tops(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """(tree, block, idx, digest) -> (tree, idx, digest) of the blocks' tops, numbered by block."""
    out = [], [], []

    def made():
        batch = pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["tree", "idx", "digest"])
        for column in out:
            column.clear()
        return batch

    for table in grouped(batches, ["tree", "block"]):
        tree, block, digests = table["tree"][0].as_py(), table["block"][0].as_py(), table["digest"].to_pylist()
        above = block_levels(digests, block, levels)
        for column, x in zip(out, (tree, block, above[-1][0].digest if above else digests[0]), strict=True):
            column.append(x)
        if len(out[0]) >= 1000:
            yield made()
    yield made()


def _down(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """A block's nodes and the siblings above it -> the siblings above each node: lefts and rights, level by level."""
    for table in grouped(batches, ["tree", "block"]):
        given, rows = _given(table)
        tree, block = table["tree"][0].as_py(), table["block"][0].as_py()
        above = block_levels([r["digest"] for r in rows], block, levels)
        out = []
        for i, r in enumerate(rows):
            lefts, rights = [], []
            for parent, slot in steps(above, i):
                lefts.append(b"".join(parent.children[:slot]).decode())
                rights.append(b"".join(parent.children[slot + 1:]).decode())
            out.append((tree, r["idx"], lefts + given[0], rights + given[1]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _SIBLINGS.types, strict=True)], schema=_SIBLINGS)


_SIBLINGS = pa.schema([("tree", pa.int64()), ("idx", pa.int64()), ("lefts", pa.list_(pa.string())), ("rights", pa.list_(pa.string()))])


def _given(table: pa.Table) -> tuple[tuple[list[str], list[str]], list[dict]]:
    """The row of siblings, which is sorted first (its idx is null), and the block's own rows."""
    rows = table.to_pylist()
    if rows and rows[0]["idx"] is None:
        return (rows[0]["lefts"], rows[0]["rights"]), rows[1:]
    return ([], []), rows


def _folded(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """A block's leaves and the siblings above it -> (doc_id, leaf, subroot, root, proof_sha256, folded_root).

    The states of the parents above the block are made once, from their left
    siblings, and copied for each leaf.  ``lefts`` and ``rights`` end with the
    levels above the subroot; the row of siblings tells how many (``top``)."""
    for table in grouped(batches, ["tree", "block"]):
        (lefts, rights), rows = _given(table)
        top = table["top"][0].as_py()
        block = table["block"][0].as_py()
        above = block_levels([r["digest"] for r in rows], block, levels)
        outer = [(hashlib.sha256(a.encode()), b.encode()) for a, b in zip(lefts, rights, strict=True)]

        def climb(digest):
            reached = [digest]
            for state, right in outer:
                state = state.copy()
                state.update(digest.encode())
                state.update(right)
                digest = state.hexdigest()
                reached.append(digest)
            return reached

        reached = climb(above[-1][0].digest if above else rows[0]["digest"])
        subroot, root = reached[len(outer) - top], reached[-1]
        tail = "".join(a + b for a, b in zip(lefts, rights, strict=True)).encode()
        out = []
        for i, r in enumerate(rows):
            proof, digest = hashlib.sha256(), r["digest"] if r["changed"] is None else r["changed"]
            for parent, slot in steps(above, i):
                for child in (*parent.children[:slot], *parent.children[slot + 1:]):
                    proof.update(child)
                digest = parent.fold(slot, digest)
            proof.update(tail)
            out.append((r["doc_id"], r["digest"], subroot, root, proof.hexdigest(), climb(digest)[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _MANIFEST.types, strict=True)], schema=_MANIFEST)


_MANIFEST = pa.schema([("doc_id", pa.int64())] + [(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")])


# --- trees -------------------------------------------------------------------------------------

def climb(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """(tree, idx, digest) of each round, each checkpointed: the given nodes, their blocks' tops and so on; the last has one node for each tree."""
    rounds = [nodes]
    while rounds[-1].filter("idx > 0").limit(1).count():
        blocks = _sorted(_in_blocks(rounds[-1].select("tree", "idx", "digest"), levels), "idx")
        rounds.append(blocks.mapInArrow(lambda b: _tops(b, levels), "tree long, idx long, digest string").checkpoint())
    return rounds


def _with_siblings(nodes: DataFrame, above: DataFrame | None, levels: int, columns: list[str]) -> DataFrame:
    """Nodes beside the row of siblings of their block: (tree, idx) of ``above`` is a node's (tree, block)."""
    blocks = _in_blocks(nodes, levels)
    if above is None:
        none = F.lit(None).cast("array<string>")
        return _sorted(blocks.select("tree", "block", "idx", *columns, none.alias("lefts"), none.alias("rights")), F.col("idx").asc_nulls_first())
    given = above.withColumnRenamed("idx", "block").withColumn("idx", F.lit(None).cast("long"))
    return _sorted(blocks.unionByName(given, allowMissingColumns=True), F.col("idx").asc_nulls_first())


def descend(rounds: list[DataFrame], above: DataFrame | None, levels: int = LEVELS) -> DataFrame | None:
    """(tree, idx, lefts, rights) of the second round's nodes, from the siblings above the last round's (tree, 0)."""
    for nodes in reversed(rounds[1:-1]):  # the last round's node is the top itself
        pass_on = _with_siblings(nodes.select("tree", "idx", "digest"), above, levels, ["digest"])
        above = pass_on.mapInArrow(lambda b: _down(b, levels), "tree long, idx long, lefts array<string>, rights array<string>").checkpoint()
    return above


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    spark = ready(docs.sparkSession)
    # Checkpointed, so the sampling for the ranges does not hash every text once more.
    hashed = leaves(docs).withColumnRenamed("leaf", "digest").checkpoint()
    placed = positions(hashed, "source", ["doc_id", "digest"], ["doc_id", "digest", "changed"]).checkpoint()
    rounds = climb(placed, levels)
    subroots = rounds[-1].select(F.lit(0).alias("all"), F.col("tree").alias("source_tree"), "digest")
    top = positions(subroots, "all", ["source_tree"], ["source_tree", "digest"]).checkpoint()
    over = climb(top, levels)
    # The siblings above each subroot; none where the only source's subroot is the root.
    pass_on = _with_siblings(top.select("tree", "idx", "digest"), descend(over, None, levels), levels, ["digest"])
    beside = pass_on.mapInArrow(lambda b: _down(b, levels), "tree long, idx long, lefts array<string>, rights array<string>")
    beside = top.select("idx", "source_tree").join(beside.drop("tree"), "idx").select(
        F.col("source_tree").alias("tree"), F.lit(0).cast("long").alias("idx"), "lefts", "rights").checkpoint()
    above = descend(rounds, beside, levels)
    # All subroots stand on one level of the top tree.
    height = beside.agg(F.max(F.size("lefts"))).first()[0] or 0
    given = above.withColumnRenamed("idx", "block").withColumn("idx", F.lit(None).cast("long")).withColumn("top", F.lit(height))
    rows = _sorted(_in_blocks(placed, levels).unionByName(given, allowMissingColumns=True), F.col("idx").asc_nulls_first())
    kinds = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return rows.mapInArrow(lambda b: _folded(b, levels), kinds).withColumn("verified", F.col("folded_root") == F.col("root"))
