"""N-gram Jaccard join by chosen paths.

Texts are sets of hashed runs of five words.  All pairs of different sets with
a Jaccard similarity of at least THRESHOLD are links.

1. Documents with equal sets are one set, known by a 128-bit hash; only sets are
   joined, so copies never multiply.
2. Each set gets MinHash values (its sampled tokens).  Two sets share a value
   with a chance equal to their similarity.
3. Every run splits all sets by the values at coordinates that the path so far
   chooses: 1.25 on average, so a pair at the threshold is expected to go on
   together in one branch.  Buckets above SMALL sets are split again, up to
   LEVELS times.  Runs choose from the same MinHash values, so they are not
   independent; ``runs_for`` repeats them until pairs at the threshold that are
   split LEVELS times meet with the chance TARGET_RECALL.  Pairs that are split
   less often, and more similar ones, meet more surely.
4. Buckets are compared by brute force in blocks of about BLOCK sets: a bucket
   that does not get smaller becomes many block pairs and no large task.  Each
   set is joined with its values once for each bucket and packed into its block;
   only whole blocks, one row each, are repeated for the pairs they belong to.
   A pair that meets in several buckets belongs to the smallest one.  First the
   MinHash values tell which sets have partners at all; only these get their
   whole sets, and similarities are exact.
5. A block returns for each set its number of links and one edge to the smallest
   set of its local component, not its pairs; a large bucket's block sums these
   over its pairs before they are rows.  Components of the edges are the classes.

Links of a group of unlike near copies are counted exactly, which takes one
comparison of MinHash values for each of its pairs; rows stay linear.

Defined results: texts of one to four words have one run, of all their words.
Null, empty or wordless texts have no set, no links and a class of their own.
Repeated rows are copies.  A null doc_id counts last when a class takes the
smallest doc_id as its id; a class without any takes a hash.  An empty table
gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.common import keyed, ready, shielding
from tremorlake.llm.graph import components
from tremorlake.llm.grouping import grouped
from tremorlake.llm.text_arrays import mix, pieces, words

N_WORDS = 5
THRESHOLD = 0.8
COORDINATES = 64
TARGET_RECALL = 0.998
#: Share, in quarters, of paths that choose two coordinates.
FORKS = 1
MOST_RUNS = 1024
SMALL = 512
LEVELS = 5
BLOCK = 256
#: Pairs with fewer equal MinHash values than the threshold less this many deviations can't be links but by a chance of about 1e-4.
SKETCH_DEVIATIONS = 4

_rng = np.random.default_rng(7)
_ODD = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)


@functools.cache
def runs_for(target: float = TARGET_RECALL, levels: int = LEVELS, similarity: float = THRESHOLD, pairs: int = 100_000) -> int:
    """The fewest runs in which the share ``target`` of simulated pairs meet after ``levels`` splits; seeded, so always the same."""
    rng = np.random.default_rng(23)
    equal = rng.random((pairs, COORDINATES)) < similarity
    apart = np.arange(pairs)
    for runs in range(1, MOST_RUNS + 1):
        together = apart
        for _ in range(levels):
            first = rng.integers(0, COORDINATES, len(together))
            second = (first + rng.integers(1, COORDINATES, len(together))) % COORDINATES
            forks = rng.integers(0, 4, len(together)) < FORKS
            together = np.concatenate([together[equal[together, first]], together[forks & equal[together, second]]])
        apart = np.setdiff1d(apart, together)
        if len(apart) <= (1 - target) * pairs:
            return runs
    raise ValueError(f"{MOST_RUNS} runs do not reach a recall of {target} at similarity {similarity}")


def least_equal(threshold: float) -> int:
    """Equal MinHash values that a pair needs to be looked at."""
    return int(np.ceil(round(threshold - SKETCH_DEVIATIONS * np.sqrt(threshold * (1 - threshold) / COORDINATES), 9) * COORDINATES))


def run_sets(word: np.ndarray, cut: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct hashes of the runs of five words of each document; cut has the documents' word offsets."""
    m = max(0, len(word) - N_WORDS + 1)
    runs = np.zeros(m, np.uint64)
    for k in range(N_WORDS):
        runs = mix(runs + word[k:m + k])
    out = []
    for a, b in zip(cut.tolist(), cut[1:].tolist(), strict=False):
        if b - a >= N_WORDS:
            out.append(np.unique(runs[a:b - N_WORDS + 1]))
        elif b > a:
            short = np.uint64(b - a)
            for h in word[a:b]:
                short = mix(np.array([short]) + h)[0]
            out.append(np.array([short], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def min_hashes(tokens: np.ndarray) -> np.ndarray:
    low = np.full(COORDINATES, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(tokens), 4096):
        np.minimum(low, ((tokens[at:at + 4096, None] * _ODD + _ADD) >> np.uint64(32)).min(0), out=low)
    return low.astype(np.uint32)


def _sets(batch_column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    for lo, data, offsets in pieces(batch_column):
        w = words(data, offsets)
        yield lo, run_sets(w.hash, np.searchsorted(w.doc, np.arange(len(offsets))))


def _signed(x) -> int:
    return int(np.array([x], np.uint64).view(np.int64)[0])


def sketches(rows: DataFrame) -> DataFrame:
    """(doc_id, row_hash, s1, s2, n, sketch): hash and size of each text's set, and its packed MinHash values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, sets in _sets(batch.column(2)):
                n = len(sets)
                s1 = [_signed(mix(s).sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
                s2 = [_signed(mix(s ^ np.uint64(0xA5A5)).sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                     pa.array([len(s) for s in sets], pa.int32()), pa.array([min_hashes(s).tobytes() if len(s) else b"" for s in sets], pa.binary())],
                    ["doc_id", "row_hash", "s1", "s2", "n", "sketch"])

    return rows.select("doc_id", "row_hash", "text").mapInArrow(run, "doc_id long, row_hash long, s1 long, s2 long, n int, sketch binary")


def chosen_paths(rows: DataFrame) -> DataFrame:
    """(s1, s2, path) one level on, of (s1, s2, sketch, path): a branch for each coordinate that the path chooses."""
    first = F.pmod(F.xxhash64("path", F.lit(1)), F.lit(COORDINATES))
    second = F.pmod(first + 1 + F.pmod(F.xxhash64("path", F.lit(2)), F.lit(COORDINATES - 1)), F.lit(COORDINATES))
    chosen = F.when(F.pmod(F.xxhash64("path", F.lit(3)), F.lit(4)) < FORKS, F.array(first, second)).otherwise(F.array(first))
    return rows.select("s1", "s2", "sketch", "path", F.explode(chosen).alias("c")).select(
        "s1", "s2", F.xxhash64("path", "c", F.substring("sketch", (F.col("c") * 4 + 1).cast("int"), F.lit(4))).alias("path"))


def leaves(sets: DataFrame, runs: int, small: int = SMALL, levels: int = LEVELS) -> DataFrame:
    """(s1, s2, leaf, size) of every bucket of two or more sets at the end of its path."""
    start = sets.select("s1", "s2", "sketch", F.explode(F.array(*[F.lit(r).cast("long") for r in range(runs)])).alias("run"))
    rows = chosen_paths(start.select("s1", "s2", "sketch", F.xxhash64(F.lit(11), "run").alias("path")))
    done = None
    for level in range(1, levels + 1):
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        sized = rows.join(sizes, "path").checkpoint()
        large = F.col("size") > small
        ended = (sized if level == levels else sized.filter(~large)).select("s1", "s2", F.col("path").alias("leaf"), "size")
        done = ended if done is None else done.unionByName(ended)
        if level == levels or not sized.filter(large).agg(F.count(F.lit(1))).first()[0]:
            return done
        rows = chosen_paths(sized.filter(large).select("s1", "s2", "path").join(sets.select("s1", "s2", "sketch"), ["s1", "s2"]))
    return done


_AT = ["leaf", "bi", "bj"]


def whole_buckets(rows: DataFrame) -> DataFrame:
    """Rows of (leaf, size, s1, s2) of buckets that are one block, as that block's pair with itself."""
    return rows.drop("size").withColumns({name: F.lit(0) for name in ("own", "bi", "bj")})


def in_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of (leaf, size, s1, s2) with the number g of their bucket's blocks and their own block."""
    blocks = F.ceil(F.col("size") / block).cast("int")
    return rows.withColumn("g", blocks).withColumn("own", F.pmod(F.xxhash64("s2", "s1"), F.col("g")).cast("int")).drop("size")


def _bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its sets as an Arrow table in bytes."""
    for table in grouped(batches, ["leaf", "own"]):
        first = table.select(["leaf", "own", "g"]).slice(0, 1)
        made = first.append_column("block", pa.array([_bytes(table.drop_columns(["leaf", "own", "g"]))], pa.binary()))
        yield from made.to_batches()


def block_pairs(rows: DataFrame) -> DataFrame:
    """(leaf, own, bi, bj, block) of rows of (leaf, own, g, ...): each packed block once for each pair (bi <= bj) that it belongs to."""
    packed = rows.repartition("leaf", "own").sortWithinPartitions("leaf", "own").mapInArrow(
        _packed, "leaf long, own int, g int, block binary").checkpoint()
    other = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    return other.select("leaf", "own", "g", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "block")


def _opened(pair: pa.Table) -> pa.Table:
    """The sets of a block pair's one or two packed blocks."""
    parts = []
    for row in pair.to_pylist():
        sets = pa.ipc.open_stream(row["block"]).read_all()
        for name, kind in (("leaf", pa.int64()), ("own", pa.int32()), ("g", pa.int32()), ("bi", pa.int32()), ("bj", pa.int32())):
            sets = sets.append_column(name, pa.repeat(pa.scalar(row[name], kind), sets.num_rows))
        parts.append(sets)
    return pa.concat_tables(parts)


def _by_block(table: pa.Table, made: pa.Table, schema: pa.Schema) -> pa.Table:
    """The rows that a block pair made of sets of ``table`` (its blocks' sets), packed by the sets' own block."""
    home = dict(zip(zip(table.column("s1").to_pylist(), table.column("s2").to_pylist(), strict=True), table.column("own").to_pylist(), strict=True))
    own = np.array([home[k] for k in zip(made.column("s1").to_pylist(), made.column("s2").to_pylist(), strict=True)], np.int64)
    rows = [{"leaf": table.column("leaf")[0].as_py(), "own": int(b), "g": table.column("g")[0].as_py(), "bi": table.column("bi")[0].as_py(),
             "bj": table.column("bj")[0].as_py(), "block": _bytes(made.filter(pa.array(own == b)))} for b in np.unique(own)]
    return pa.Table.from_pylist(rows, schema)


_PAIR = pa.schema([("leaf", pa.int64()), ("own", pa.int32()), ("g", pa.int32()), ("bi", pa.int32()), ("bj", pa.int32()), ("block", pa.binary())])
_PAIR_DDL = "leaf long, own int, g int, bi int, bj int, block binary"


def _of_pairs(step):
    """``step``, from sets of a block pair to rows of them, over pairs of packed blocks."""
    def run(pair: pa.Table) -> pa.Table:
        table = _opened(pair)
        made = list(step(iter([table])))
        return _by_block(table, pa.Table.from_batches(made), _PAIR) if made else _PAIR.empty_table()
    return run


def _read(table: pa.Table) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in table.column("block").to_pylist()])


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(s1, s2, leaf, own, g) of the sets that any pair of their block names, once each."""
    for table in grouped(batches, ["leaf", "own"]):
        sets = _read(table).select(["s1", "s2"]).group_by(["s1", "s2"]).aggregate([])
        for name in ("leaf", "own", "g"):
            sets = sets.append_column(name, pa.repeat(table.column(name)[0], sets.num_rows))
        yield from sets.select(["s1", "s2", "leaf", "own", "g"]).to_batches()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links per set of a block over all its pairs, and one edge of every set and root to the smallest one they are connected with there."""
    for table in grouped(batches, ["leaf", "own"]):
        rows = _read(table)
        up: dict[tuple, tuple] = {}

        def top(x, up=up):
            while (y := up.setdefault(x, x)) != x:
                up[x] = x = up[y]
            return x

        links: dict[tuple, int] = {}
        for s1, s2, n, r1, r2 in zip(*(rows.column(c).to_pylist() for c in ("s1", "s2", "links", "r1", "r2")), strict=True):
            links[s1, s2] = links.get((s1, s2), 0) + n
            a, b = sorted((top((s1, s2)), top((r1, r2))))
            up[b] = a
        nodes = list(up)
        tops = [top(x) for x in nodes]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in nodes], pa.int64()), pa.array([x[1] for x in nodes], pa.int64()), pa.array([links.get(x, 0) for x in nodes], pa.int64()),
             pa.array([x[0] for x in tops], pa.int64()), pa.array([x[1] for x in tops], pa.int64())], ["s1", "s2", "links", "r1", "r2"])


def _owned(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(k x k: whether the pair is this block's, packed ids): in different blocks where the blocks differ, and in no smaller leaf together."""
    k, leaf = table.num_rows, table.column("leaf")[0].as_py()
    own, bi, bj = table.column("own").to_numpy(), table.column("bi")[0].as_py(), table.column("bj")[0].as_py()
    ids = np.stack([table.column("s1").to_numpy(), table.column("s2").to_numpy()], 1)
    mine = np.ones((k, k), bool) if bi == bj else own[:, None] != own[None, :]
    lists = table.column("leaves").combine_chunks()
    row = np.repeat(np.arange(k), np.diff(lists.offsets.to_numpy()))
    value = lists.flatten().to_numpy(zero_copy_only=False)
    early = value < leaf
    row, value = row[early], value[early]
    order = np.argsort(value, kind="stable")
    row, value = row[order], value[order]
    for part in np.split(row, np.flatnonzero(value[1:] != value[:-1]) + 1):
        if len(part) > 1:
            mine[np.ix_(part, part)] = False
    return np.triu(mine, 1), ids


def _near(table: pa.Table, least: int) -> np.ndarray:
    sketch = np.stack([np.frombuffer(s, np.uint32) for s in table.column("sketch").to_pylist()], 1)
    same = np.zeros((sketch.shape[1],) * 2, np.uint8)
    for values in sketch:
        same += values[:, None] == values[None, :]
    return same >= least


def _partners(tables: Iterator[pa.Table], least: int) -> Iterator[pa.RecordBatch]:
    """The sets that have a likely partner in their block pair."""
    for table in tables:
        if table.num_rows < 2:
            continue
        mine, _ = _owned(table)
        pair = mine & _near(table, least)
        has = pair.any(0) | pair.any(1)
        if has.any():
            yield from table.select(["s1", "s2", "leaf", "bi", "bj", "own"]).filter(pa.array(has)).to_batches()


def common_tokens(sets: list[np.ndarray], columns: int = 2048) -> np.ndarray:
    """k x k: number of tokens that two sets share."""
    k = len(sets)
    row = np.repeat(np.arange(k), [len(s) for s in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[token]
    row, token = row[keep], number[token[keep]]
    out = np.zeros((k, k), np.float64)
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    for lo in range(0, int(token[-1]) + 1 if len(token) else 0, columns):
        a, b = np.searchsorted(token, [lo, lo + columns])
        m = np.zeros((k, columns), np.float32)
        m[row[a:b], token[a:b] - lo] = 1
        out += m @ m.T
    return out


def _links(tables: Iterator[pa.Table], threshold: float) -> Iterator[pa.RecordBatch]:
    """Per set of a block pair: its links there and the smallest set of its local component."""
    for table in tables:
        if table.num_rows < 2:
            continue
        mine, ids = _owned(table)
        sets = [np.frombuffer(s, np.uint64) for s in table.column("tokens").to_pylist()]
        size = np.array([len(s) for s in sets], np.float64)
        common = common_tokens(sets)
        link = mine & (common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9)
        count = link.sum(0) + link.sum(1)
        root = np.full(len(sets), -1)
        both = link | link.T
        order = np.lexsort((ids[:, 1], ids[:, 0]))
        for i in order.tolist():
            if root[i] < 0:
                root[i] = i
                ahead = [i]
                while ahead:
                    near = np.flatnonzero(both[ahead.pop()] & (root < 0))
                    root[near] = i
                    ahead += near.tolist()
        has = np.flatnonzero(count)
        if len(has):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[has, 0]), pa.array(ids[has, 1]), pa.array(count[has].astype(np.int64)), pa.array(ids[root[has], 0]), pa.array(ids[root[has], 1])],
                ["s1", "s2", "links", "r1", "r2"])


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, sets in _sets(batch.column(2)):
            n = len(sets)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             ["s1", "s2", "tokens"])


def _key(kind: str, *columns: str) -> Column:
    """The values of the columns as one text, different for different values."""
    return F.concat_ws(":", F.lit(kind), *[F.coalesce(F.hex(c), F.lit("-")) for c in columns])


def join(docs: DataFrame, threshold: float = THRESHOLD, runs: int | None = None, small: int = SMALL, levels: int = LEVELS, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, row_hash, class_id, class_key, n_links, n_copies.

    n_links counts the different sets that its set is linked with, n_copies the
    documents with its own set.  class_id is the smallest doc_id of its class; as
    a doc_id may stand on unlike texts, class_key is what tells classes apart.
    ``runs`` follow from TARGET_RECALL where they are not given.
    """
    ready(docs.sparkSession)
    rows = keyed(docs)
    base = sketches(rows).checkpoint()
    sets = base.filter("n > 0").groupBy("s1", "s2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash")).alias("rep"),
        F.count(F.lit(1)).alias("n_copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch")).checkpoint()
    found = leaves(sets, runs or runs_for(TARGET_RECALL, levels, threshold), small, levels).distinct().checkpoint()
    whole_leaf = F.col("size") <= block
    own_leaves = found.groupBy("s1", "s2").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
    least, schema = least_equal(threshold), "s1 long, s2 long, leaf long, bi int, bj int, own int"

    def sketched(rows: DataFrame) -> DataFrame:
        return rows.join(own_leaves, ["s1", "s2"]).join(sets.select("s1", "s2", "sketch"), ["s1", "s2"])

    partners = sketched(whole_buckets(found.filter(whole_leaf))).repartition(*_AT).sortWithinPartitions(*_AT).mapInArrow(
        lambda b: _partners(grouped(b, _AT), least), schema).checkpoint()
    likely = block_pairs(sketched(in_blocks(found.filter(~whole_leaf), block))).groupBy(*_AT).applyInArrow(
        _of_pairs(lambda t: _partners(t, least)), _PAIR_DDL).checkpoint()
    united = likely.select("leaf", "own", "g", "block").repartition("leaf", "own").sortWithinPartitions("leaf", "own").mapInArrow(
        _united, "s1 long, s2 long, leaf long, own int, g int").checkpoint()
    wanted = partners.select("s1", "s2").unionByName(united.select("s1", "s2")).distinct().join(sets.select("s1", "s2", "rep"), ["s1", "s2"]).select(
        "s1", "s2", F.col("rep.doc_id").alias("rep_doc"), F.col("rep.row_hash").alias("rep_hash"))
    at = F.col("doc_id").eqNullSafe(F.col("rep_doc")) & (F.col("row_hash") == F.col("rep_hash"))
    tokens = rows.join(wanted, at).select("s1", "s2", "text").mapInArrow(_token_rows, "s1 long, s2 long, tokens binary")
    tokens = tokens.checkpoint()
    facts_of = "s1 long, s2 long, links long, r1 long, r2 long"

    def whole(rows: DataFrame) -> DataFrame:
        return rows.join(own_leaves, ["s1", "s2"]).join(tokens, ["s1", "s2"])

    linked = whole(partners).repartition(*_AT).sortWithinPartitions(*_AT).mapInArrow(lambda b: _links(grouped(b, _AT), threshold), facts_of)
    met = block_pairs(whole(united)).join(likely.select(*_AT).distinct(), _AT, "left_semi")
    of_blocks = met.groupBy(*_AT).applyInArrow(_of_pairs(lambda t: _links(t, threshold)), _PAIR_DDL)
    of_blocks = of_blocks.select("leaf", "own", "block").repartition("leaf", "own").sortWithinPartitions("leaf", "own").mapInArrow(_summed, facts_of)
    linked = linked.unionByName(of_blocks).checkpoint()
    counts = linked.groupBy("s1", "s2").agg(F.sum("links").alias("n_links"))
    rooted = components(linked.select(F.struct("s1", "s2").alias("u"), F.struct(F.col("r1").alias("s1"), F.col("r2").alias("s2")).alias("v")))
    named = sets.select("s1", "s2", "n_copies", F.coalesce("rep.doc_id", "s1").alias("name")).join(
        rooted.select("u.s1", "u.s2", "root"), ["s1", "s2"], "left").withColumn("root", F.coalesce("root", F.struct("s1", "s2")))
    class_names = named.groupBy("root").agg(F.min("name").alias("class_id"))
    facts = named.join(class_names, "root").join(counts, ["s1", "s2"], "left").select(
        F.col("s1").alias("f1"), F.col("s2").alias("f2"), "class_id",
        _key("set", "root.s1", "root.s2").alias("class_key"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "n_copies")
    own = F.coalesce(F.col("doc_id"), F.col("row_hash"))
    return base.join(facts, (F.col("s1") == F.col("f1")) & (F.col("s2") == F.col("f2")) & (F.col("n") > 0), "left").select(
        "doc_id", "row_hash", F.coalesce("class_id", own).alias("class_id"),
        F.coalesce("class_key", _key("row", "doc_id", "row_hash")).alias("class_key"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"))


@shielding
def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, but one of each class: the one with the smallest doc_id and, of equal ids, text hash.

    Repeated rows that agree in both stay once.
    """
    joined = join(docs, threshold)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash")
    # Partial counts per row first, so a row that is repeated very often stays spread.
    rows = joined.groupBy("class_key", "doc_id", "row_hash").agg(F.count(F.lit(1)).alias("rows"))
    kept = rows.groupBy("class_key").agg(F.min(F.struct(order.alias("o"), "rows")).alias("k")).select(
        F.col("k.o.doc_id").alias("__doc"), F.col("k.o.row_hash").alias("__hash"), F.col("k.rows").alias("__rows")).checkpoint()
    doc, text_hash = docs["doc_id"].cast("long"), F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    at = doc.eqNullSafe(F.col("__doc")) & (text_hash == F.col("__hash"))
    once = docs.join(kept.filter("__rows = 1"), at, "left_semi")
    repeated = kept.filter("__rows > 1")
    if repeated.isEmpty():
        return once
    several = docs.join(repeated, at, "left_semi").withColumns({"__doc": F.col("doc_id").cast("long"), "__hash": F.xxhash64(F.coalesce("text", F.lit("")))})
    return once.unionByName(several.dropDuplicates(["__doc", "__hash"]).drop("__doc", "__hash"))
