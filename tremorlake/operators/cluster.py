"""Density clusters (G4, G5, A9): DBSCAN over planar degrees.

With min_points = 1, the case of every query but one, every point is a core point, so clusters are the connected
components of the graph "distance <= eps".  The plan never pairs up all points
of a group:

1. Points go to grid cells of side eps/sqrt(2): two points of one cell are
   always within eps, so each occupied cell is one node.  Exact duplicate
   coordinates collapse first (a pile of copies is one point).
2. Two cells can only touch if they lie within 2 cells of each other (24
   neighbours; each pair is produced once).
3. Whether two neighbouring cells touch is decided on occupied sub-cells: a
   sub-cell pair whose farthest corners are within eps decides "yes", one
   whose nearest sides are beyond eps decides "no".  Undecided sub-cell pairs
   are split 4 x 4 and tested again (level by level, down to sub-cells of
   at most 1e-5 degrees); only a small residue (few points on each side, or the
   finest level, which holds at most ~10 x 10 distinct six-decimal points)
   compares points.  Dense regions are decided on sub-cells, so point pairs
   are never emitted for them.
4. Connected components over cells: a grouped union-find inside fixed tiles
   of 32 x 32 cells (applyInPandas; group size bounded by the grid), then
   min-label propagation with pointer jumping over the contracted graph of
   tile components; every round is checkpoint()ed to the session's checkpoint
   dir, which cuts the lineage and lets a lost executor cost one round at most.

The cell and sub-cell tables are bounded by geography (the grid), not by the
number of events; all aggregates are partial-then-final.

With more min_points a point is a core point if that many points, itself
included, lie within eps.  All points of a cell with that many are core points,
so only points of sparser cells (fewer than min_points in each) are counted:
against whole sub-cells where the geometry decides, against points in the
sub-cells on the rim.  Clusters are the components of the core points; other
points within eps of one take the smallest such cluster; the rest is noise.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..session import BROADCAST_ROW_LIMIT, broadcast_checked, ensure_checkpoint_dir

KM_PER_DEGREE = 111.32          # fixed value: eps = radius_km / 111.32
SUB_PER_CELL_BITS = 3           # 8 x 8 sub-cells per cell at the first level
LEVEL_BITS = 2                  # each refinement splits a sub-cell 4 x 4
FINEST_SIDE_DEG = 1e-5          # refinement stops at sub-cells this small (10 x 10 coordinate units)
POINT_PAIR_BUDGET = 4096        # residue pairs compared point by point
MARGIN = 1e-9


def eps_from_km(radius_km: float) -> float:
    return float(radius_km) / KM_PER_DEGREE


def _levels(eps: float) -> int:
    """Refinements (each a 4 x 4 split) after the first 8 x 8 split until a
    sub-cell side is at most FINEST_SIDE_DEG.  Coordinates have six decimals and exact duplicates are
    collapsed, so a finest sub-cell holds at most ~10 x 10 distinct points."""
    first = eps / math.sqrt(2) / (1 << SUB_PER_CELL_BITS)
    return max(0, math.ceil(math.log2(max(first / FINEST_SIDE_DEG, 1.0)) / LEVEL_BITS))


def _quantum(eps: float) -> float:
    # Cell side = quantum * 2^(SUB_PER_CELL_BITS + LEVEL_BITS * levels) = eps/sqrt(2), shrunk a hair.
    return eps / math.sqrt(2) * (1 - MARGIN) / (1 << (SUB_PER_CELL_BITS + LEVEL_BITS * _levels(eps)))


def _cell_cols(eps: float, x_col: str, y_col: str) -> list:
    """qx, qy (finest lattice) and cx, cy (cell) of a point, as columns."""
    u = _quantum(eps)
    shift = SUB_PER_CELL_BITS + LEVEL_BITS * _levels(eps)
    qx = F.floor(F.col(x_col).cast("double") / F.lit(u)).cast("long")
    qy = F.floor(F.col(y_col).cast("double") / F.lit(u)).cast("long")
    return [qx.alias("qx"), qy.alias("qy"), F.shiftright(qx, shift).alias("cx"), F.shiftright(qy, shift).alias("cy")]


def _points(df: DataFrame, eps: float, id_col: str, x_col: str, y_col: str) -> DataFrame:
    p = df.filter(F.col(x_col).isNotNull() & F.col(y_col).isNotNull())
    return p.select(F.col(id_col).alias("pid"), F.col(x_col).cast("double").alias("x"),
                    F.col(y_col).cast("double").alias("y"), *_cell_cols(eps, x_col, y_col))


def _sub_key(level: int, levels: int):
    """Sub-cell coordinates at ``level`` (0 = 8x8 per cell) of ``levels``."""
    sh = LEVEL_BITS * (levels - level)
    return F.shiftright("qx", sh).alias("sx"), F.shiftright("qy", sh).alias("sy")


def _classify(pairs: DataFrame, level: int, eps: float) -> DataFrame:
    """Adds ``kind``: 1 certain edge, 0 no edge, -1 undecided, from sub-cell geometry."""
    w = _quantum(eps) * (1 << (LEVEL_BITS * (_levels(eps) - level)))

    def gap(a, b):
        # distance between integer intervals [a, a+1) and [b, b+1), in cells of width w
        return F.greatest(F.abs(a - b) - F.lit(1), F.lit(0)).cast("double") * F.lit(w)

    def span(a, b):
        return (F.abs(a - b) + F.lit(1)).cast("double") * F.lit(w)

    dmin2 = F.pow(gap(F.col("ax"), F.col("bx")), 2) + F.pow(gap(F.col("ay"), F.col("by")), 2)
    dmax2 = F.pow(span(F.col("ax"), F.col("bx")), 2) + F.pow(span(F.col("ay"), F.col("by")), 2)
    e2 = eps * eps
    kind = (F.when(dmax2 <= F.lit(e2 * (1 - MARGIN)), F.lit(1))
            .when(dmin2 > F.lit(e2 * (1 + MARGIN)), F.lit(0)).otherwise(F.lit(-1)))
    return pairs.withColumn("kind", kind)


def cell_edges(pts: DataFrame, eps: float) -> tuple[DataFrame, DataFrame]:
    """(cells, edges): cells (cx, cy, node) and undirected cell edges (na, nb) by node id.

    ``pts`` should be materialised (checkpointed) by the caller: every level
    reads it.  Levels run eagerly and stop as soon as nothing is undecided.
    """
    levels = _levels(eps)
    cells = pts.groupBy("cx", "cy").agg(F.min("pid").alias("node")).checkpoint(eager=True)
    offsets = [(dx, dy) for dx in range(-2, 3) for dy in range(-2, 3) if dx > 0 or (dx == 0 and dy > 0)]
    off = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in offsets]))
    nb = cells.select("cx", "cy", "node", off.alias("o")).select(
        F.col("node").alias("na"), (F.col("cx") + F.col("o.dx")).alias("bcx"), (F.col("cy") + F.col("o.dy")).alias("bcy"))
    cand = nb.join(cells.select(F.col("cx").alias("bcx"), F.col("cy").alias("bcy"), F.col("node").alias("nb")),
                   ["bcx", "bcy"]).select("na", "nb")
    # cells are bounded by the grid, not the data: broadcast once the count is
    # proven, so a cell holding a third of all points is not one hot shuffle key.
    keyed = pts.join(broadcast_checked(cells), ["cx", "cy"]).select("node", "qx", "qy", "x", "y")

    def occupied(level: int) -> DataFrame:
        return keyed.groupBy("node", *_sub_key(level, levels)).agg(F.count(F.lit(1)).alias("n"))

    def sides(occ: DataFrame, parent: bool):
        cols_a = [F.col("node").alias("na"), F.col("n").alias("an")]
        cols_b = [F.col("node").alias("nb"), F.col("n").alias("bn")]
        if parent:
            cols_a += [F.shiftright("sx", LEVEL_BITS).alias("ax"), F.shiftright("sy", LEVEL_BITS).alias("ay"),
                       F.col("sx").alias("cax"), F.col("sy").alias("cay")]
            cols_b += [F.shiftright("sx", LEVEL_BITS).alias("bx"), F.shiftright("sy", LEVEL_BITS).alias("by"),
                       F.col("sx").alias("cbx"), F.col("sy").alias("cby")]
        else:
            cols_a += [F.col("sx").alias("ax"), F.col("sy").alias("ay")]
            cols_b += [F.col("sx").alias("bx"), F.col("sy").alias("by")]
        return occ.select(*cols_a), occ.select(*cols_b)

    a, b = sides(occupied(0), parent=False)
    pairs = _classify(cand.join(a, "na").join(b, "nb"), 0, eps).checkpoint(eager=True)
    decided = [pairs.filter(F.col("kind") == 1).select("na", "nb").distinct()]
    open_pairs = pairs.filter(F.col("kind") == -1).join(decided[0], ["na", "nb"], "left_anti")
    residues = []
    small = F.col("an") * F.col("bn") <= F.lit(POINT_PAIR_BUDGET)
    for level in range(0, levels + 1):
        if level == levels:
            residues.append((level, open_pairs))
            break
        residues.append((level, open_pairs.filter(small)))
        seen = Observation()
        big = (open_pairs.filter(~small).select("na", "nb", "ax", "ay", "bx", "by")
               .observe(seen, F.count(F.lit(1)).alias("n")).checkpoint(eager=True))
        if seen.get["n"] == 0:
            break
        ca, cb = sides(occupied(level + 1), parent=True)
        refined = big.join(ca, ["na", "ax", "ay"]).join(cb, ["nb", "bx", "by"]).select(
            "na", "nb", F.col("cax").alias("ax"), F.col("cay").alias("ay"), "an",
            F.col("cbx").alias("bx"), F.col("cby").alias("by"), "bn")
        refined = _classify(refined, level + 1, eps).checkpoint(eager=True)
        decided.append(refined.filter(F.col("kind") == 1).select("na", "nb").distinct())
        # Cell pairs that are decided by now are refined no further.
        open_pairs = refined.filter(F.col("kind") == -1).join(decided[-1], ["na", "nb"], "left_anti")

    e2 = eps * eps
    for level, res in residues:
        p_level = keyed.select("node", "x", "y", *_sub_key(level, levels))
        pa = p_level.select(F.col("node").alias("na"), F.col("sx").alias("ax"), F.col("sy").alias("ay"),
                            F.col("x").alias("x1"), F.col("y").alias("y1"))
        pb = p_level.select(F.col("node").alias("nb"), F.col("sx").alias("bx"), F.col("sy").alias("by"),
                            F.col("x").alias("x2"), F.col("y").alias("y2"))
        res = broadcast_checked(res.select("na", "nb", "ax", "ay", "bx", "by"))
        r = pa.join(res, ["na", "ax", "ay"]).join(pb, ["nb", "bx", "by"])
        d2 = (F.col("x1") - F.col("x2")) * (F.col("x1") - F.col("x2")) + (F.col("y1") - F.col("y2")) * (F.col("y1") - F.col("y2"))
        decided.append(r.filter(d2 <= F.lit(e2)).select("na", "nb"))
    edges = decided[0]
    for d in decided[1:]:
        edges = edges.unionByName(d)
    return cells, edges.distinct()


def star_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (na, nb) between different nodes: label is its component's smallest node.

    Alternating stars: first every node hangs its larger neighbours on the
    smallest node around it, then every node hangs itself and its smaller
    neighbours on the smallest of them; rounds go on until nothing changes,
    about the logarithm of the nodes.  Joins are on nodes, never on labels.  A
    node with very many neighbours (the middle of a giant component) is a key
    with many rows on one side and one row on the other; the one-row side is read
    from a checkpoint, so both sides are dealt anew and the hot key is split.
    """
    now = edges.filter("na <> nb").select(F.greatest("na", "nb").alias("u"), F.least("na", "nb").alias("v")).distinct().checkpoint(eager=True)
    before = None
    while True:
        around = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).checkpoint(eager=True)
        hung = around.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().checkpoint(eager=True)
        low = hung.groupBy("u").agg(F.min("v").alias("m")).checkpoint(eager=True)
        own = low.select("u", F.col("m").alias("v"))
        seen = Observation()
        now = hung.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).distinct()
        now = now.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).checkpoint(eager=True)
        if seen.get == before:
            break
        before = seen.get
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def connected_components(nodes: DataFrame, edges: DataFrame, jumps: int = 1) -> DataFrame:
    """(node, label): label = smallest node id of the node's component.

    Where the nodes are proven within the broadcast bound (e.g. the contracted
    graph), their labels are shipped to the tasks in every round: every node
    takes the smallest label among itself and its neighbours, then follows label
    -> label-of-label ``jumps`` times (pointer jumping).  The round's result is
    checkpointed; the number of changed labels is an observed metric of that same
    job, so the stop test costs no extra job.  Larger graphs take alternating
    stars (``star_components``): a join on labels would put a giant component's
    rows on one key.
    """
    spark = nodes.sparkSession
    ensure_checkpoint_dir(spark)
    sized = Observation()
    labels = (nodes.select("node", F.col("node").alias("label"))
              .observe(sized, F.count(F.lit(1)).alias("n")).checkpoint(eager=True))
    if sized.get["n"] > BROADCAST_ROW_LIMIT:
        found = star_components(edges).withColumnRenamed("label", "_found").checkpoint(eager=True)
        return labels.join(found, "node", "left").select("node", F.coalesce("_found", "label").alias("label"))
    und = edges.select(F.col("na").alias("src"), F.col("nb").alias("dst")).unionByName(
        edges.select(F.col("nb").alias("src"), F.col("na").alias("dst")))
    und = und.checkpoint(eager=True)
    ship = F.broadcast
    while True:  # labels only get smaller, so this ends; no round limit may cut it off
        nbr = und.join(ship(labels.withColumnRenamed("node", "src")), "src").groupBy("dst").agg(
            F.min("label").alias("m"))
        step = labels.join(ship(nbr.withColumnRenamed("dst", "node")), "node", "left").select(
            "node", F.col("label").alias("old"),
            F.least(F.col("label"), F.coalesce(F.col("m"), F.col("label"))).alias("label"))
        for _j in range(jumps):
            step = step.alias("a").join(ship(step.alias("b")), F.col("a.label") == F.col("b.node"), "left").select(
                F.col("a.node").alias("node"), F.col("a.old").alias("old"),
                F.least(F.col("a.label"), F.coalesce(F.col("b.label"), F.col("a.label"))).alias("label"))
        moved = Observation()
        labels = step.observe(moved, F.count(F.when(F.col("label") != F.col("old"), 1)).alias("n")).select(
            "node", "label").checkpoint(eager=True)
        if moved.get["n"] == 0:
            break
    return labels


TILE_BITS = 5                    # 32 x 32 cells per tile for the local contraction


def _tile_union_find(_key, nodes, edges):
    """Union-find over one tile's nodes and intra-tile edges (pandas in, pandas out).

    A tile holds at most 2^(2*TILE_BITS) cells and 12 edges per cell, so the
    group size is bounded by the grid, not by the data."""
    import numpy as np
    import pandas as pd

    ids = nodes["node"].to_numpy(dtype="int64")
    pos = {int(v): i for i, v in enumerate(ids)}
    parent = np.arange(len(ids))

    def find(i):
        root = i
        while parent[root] != root:
            root = parent[root]
        while parent[i] != root:
            parent[i], i = root, parent[i]
        return root

    for a, b in zip(edges["na"].to_numpy(dtype="int64"), edges["nb"].to_numpy(dtype="int64")):
        ra, rb = find(pos[int(a)]), find(pos[int(b)])
        if ra != rb:
            # keep the root with the smaller node id
            if ids[ra] < ids[rb]:
                parent[rb] = ra
            else:
                parent[ra] = rb
    roots = np.array([find(i) for i in range(len(ids))], dtype="int64")
    return pd.DataFrame({"node": ids, "local": ids[roots] if len(ids) else ids})


def contracted_components(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label) like ``connected_components``, in fewer rounds: components
    inside each tile come from one grouped union-find, and only the graph of
    tile-local components and cross-tile edges is iterated."""
    tx = F.shiftright("cx", TILE_BITS).alias("tx")
    ty = F.shiftright("cy", TILE_BITS).alias("ty")
    node_tile = broadcast_checked(cells.select("node", tx, ty))
    a = node_tile.select(F.col("node").alias("na"), F.col("tx").alias("atx"), F.col("ty").alias("aty"))
    b = node_tile.select(F.col("node").alias("nb"), F.col("tx").alias("btx"), F.col("ty").alias("bty"))
    e = edges.join(a, "na").join(b, "nb")
    same = (F.col("atx") == F.col("btx")) & (F.col("aty") == F.col("bty"))
    intra = e.filter(same).select(F.col("atx").alias("tx"), F.col("aty").alias("ty"), "na", "nb")
    cross = e.filter(~same).select("na", "nb")
    local = (cells.select("node", tx, ty).groupBy("tx", "ty")
             .cogroup(intra.groupBy("tx", "ty"))
             .applyInPandas(_tile_union_find, "node long, local long")).checkpoint(eager=True)
    la = local.select(F.col("node").alias("na"), F.col("local").alias("la"))
    lb = local.select(F.col("node").alias("nb"), F.col("local").alias("lb"))
    c_edges = (cross.join(la, "na").join(lb, "nb").filter(F.col("la") != F.col("lb"))
               .select(F.col("la").alias("na"), F.col("lb").alias("nb")).distinct())
    c_nodes = local.select(F.col("local").alias("node")).distinct()
    top = connected_components(c_nodes, c_edges)
    return local.join(top.withColumnRenamed("node", "local"), "local").select("node", "label")


def _reached(queries: DataFrame, targets: DataFrame, eps: float) -> DataFrame:
    """(pid, cx, cy, n): how many target points (by weight) of each cell lie within eps of a query point.

    Sub-cells that lie wholly within eps count by their sum, those wholly beyond
    not at all; only points of sub-cells on the rim are compared one by one."""
    levels = _levels(eps)
    w = _quantum(eps) * (1 << (LEVEL_BITS * levels))
    placed = targets.select("cx", "cy", *_sub_key(0, levels), F.col("x").alias("x2"), F.col("y").alias("y2"), "weight")
    occupied = placed.groupBy("cx", "cy", "sx", "sy").agg(F.sum("weight").alias("n"))
    off = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in range(-2, 3) for dy in range(-2, 3)]))
    asked = queries.select("pid", "x", "y", "cx", "cy", off.alias("o")).select(
        "pid", "x", "y", (F.col("cx") + F.col("o.dx")).alias("cx"), (F.col("cy") + F.col("o.dy")).alias("cy"))
    near = asked.join(occupied, ["cx", "cy"])

    def nearest_and_farthest(at: str, sub: str):
        low, high = F.col(sub) * F.lit(w), (F.col(sub) + F.lit(1)) * F.lit(w)
        return (F.greatest(low - F.col(at), F.col(at) - high, F.lit(0.0)), F.greatest(F.abs(F.col(at) - low), F.abs(high - F.col(at))))

    (x_min, x_max), (y_min, y_max) = nearest_and_farthest("x", "sx"), nearest_and_farthest("y", "sy")
    e2 = eps * eps
    inside = x_max * x_max + y_max * y_max <= F.lit(e2 * (1 - MARGIN))
    beyond = x_min * x_min + y_min * y_min > F.lit(e2 * (1 + MARGIN))
    sure = near.filter(inside).select("pid", "cx", "cy", "n")
    dx, dy = F.col("x") - F.col("x2"), F.col("y") - F.col("y2")
    rim = near.filter(~inside & ~beyond).drop("n").join(placed, ["cx", "cy", "sx", "sy"]).filter(dx * dx + dy * dy <= F.lit(e2))
    return sure.unionByName(rim.select("pid", "cx", "cy", F.col("weight").alias("n"))).groupBy("pid", "cx", "cy").agg(F.sum("n").alias("n"))


def _core_clusters(pts: DataFrame, eps: float, min_points: int) -> tuple[DataFrame, DataFrame]:
    """(cells, sparse): the cluster of the core points of a cell (cx, cy, cluster_id),
    and the points of cells with fewer than min_points, with their own cluster_id (null: noise)."""
    cell_n = pts.groupBy("cx", "cy").agg(F.sum("weight").alias("cell_n")).checkpoint(eager=True)
    at = pts.join(broadcast_checked(cell_n), ["cx", "cy"])
    sparse = at.filter(F.col("cell_n") < min_points).drop("cell_n").checkpoint(eager=True)
    counted = _reached(sparse, pts, eps).groupBy("pid").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_points).select("pid")
    some = sparse.join(counted, "pid", "left_semi").checkpoint(eager=True)
    core = at.filter(F.col("cell_n") >= min_points).drop("cell_n").unionByName(some).checkpoint(eager=True)
    cells, edges = cell_edges(core, eps)
    labels = contracted_components(cells, edges)
    cell_label = cells.join(labels, "node").select("cx", "cy", F.col("label").alias("cluster_id")).checkpoint(eager=True)
    other = sparse.join(some.select("pid"), "pid", "left_anti")
    border = _reached(other, core, eps).join(broadcast_checked(cell_label), ["cx", "cy"]).groupBy("pid").agg(F.min("cluster_id").alias("cluster_id"))
    own = some.join(broadcast_checked(cell_label), ["cx", "cy"]).select("pid", "cluster_id")
    return cell_label, sparse.select("pid", "x", "y").join(own.unionByName(border), "pid", "left").select("x", "y", "cluster_id")


def cluster_dbscan(df: DataFrame, eps: float, min_points: int = 1, id_col: str = "id",
                   x_col: str = "longitude", y_col: str = "latitude") -> DataFrame:
    """``df`` plus ``cluster_id`` (smallest ``id_col`` of the component's core
    points); rows without coordinates, and noise where min_points is more than 1, get null."""
    if min_points < 1:
        raise ValueError("min_points is 1 or more")
    ensure_checkpoint_dir(df.sparkSession)
    pts = _points(df, eps, id_col, x_col, y_col)
    dedup = pts.groupBy("qx", "qy", "x", "y", "cx", "cy").agg(F.min("pid").alias("pid"), F.count(F.lit(1)).alias("weight")).checkpoint(eager=True)
    if min_points > 1:
        cell_label, sparse = _core_clusters(dedup, eps, min_points)
        # A sparse cell has fewer than min_points rows: their table is bounded by the grid too.
        x, y = F.col(x_col).cast("double").alias("x"), F.col(y_col).cast("double").alias("y")
        keyed = df.select("*", *_cell_cols(eps, x_col, y_col)[2:], x, y)
        keyed = keyed.join(broadcast_checked(cell_label.withColumnRenamed("cluster_id", "_of_cell")), ["cx", "cy"], "left")
        points = sparse.withColumn("_sparse", F.lit(True)).withColumnRenamed("cluster_id", "_of_point").checkpoint(eager=True)
        keyed = keyed.join(broadcast_checked(points), ["x", "y"], "left")
        own = F.when(F.col("_sparse"), F.col("_of_point")).otherwise(F.col("_of_cell"))
        return keyed.select(*df.columns, own.alias("cluster_id"))
    cells, edges = cell_edges(dedup, eps)
    labels = contracted_components(cells, edges)
    cell_label = cells.join(labels, "node").select("cx", "cy", F.col("label").alias("cluster_id"))
    # Label the input by recomputing its cell key: one join with the (grid-
    # bounded) cell table instead of a shuffle of two large sides on the id.
    keyed = df.select("*", *_cell_cols(eps, x_col, y_col)[2:])
    return keyed.join(broadcast_checked(cell_label), ["cx", "cy"], "left").drop("cx", "cy")


def clusters(df: DataFrame, radius_km: float = 50, days: int = 7, as_of=None) -> DataFrame:
    """Clusters of the last ``days`` days at ``radius_km``: centroid (4
    places), count, average and maximum magnitude (2 places), largest first."""
    from .query import since

    recent = since(df, as_of, days)
    labelled = cluster_dbscan(recent.select("id", "mag", "longitude", "latitude"), eps_from_km(radius_km))
    g = labelled.filter(F.col("cluster_id").isNotNull()).groupBy("cluster_id").agg(
        S.avg_rounded("latitude", 6, 4).alias("centroid_lat"),
        S.avg_rounded("longitude", 6, 4).alias("centroid_lng"),
        F.count(F.lit(1)).alias("earthquake_count"),
        S.avg_rounded("mag").alias("avg_mag"),
        F.max("mag").cast("double").alias("max_mag"),
    )
    return g.orderBy(F.col("earthquake_count").desc(), F.col("cluster_id"))
