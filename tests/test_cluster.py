"""Density clusters against brute force (numpy union-find)."""

from decimal import Decimal

import numpy as np
import pytest

from tremorlake.operators import cluster as CL


def brute(xs, ys, ids, eps):
    parent = list(range(len(xs)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for i in range(len(xs)):
        d2 = (xs[i] - xs) ** 2 + (ys[i] - ys) ** 2
        for j in np.nonzero(d2 <= eps * eps)[0]:
            a, b = find(i), find(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
    comp = {}
    for i in range(len(xs)):
        comp.setdefault(find(i), []).append(ids[i])
    return {i: min(members) for members in comp.values() for i in members}


def frame(spark, xs, ys):
    rows = [(i + 1, Decimal(f"{x:.6f}"), Decimal(f"{y:.6f}")) for i, (x, y) in enumerate(zip(xs, ys))]
    return spark.createDataFrame(rows, "id long, longitude decimal(10,6), latitude decimal(10,6)")


def check(spark, xs, ys, eps):
    xs = np.round(np.asarray(xs, dtype=float), 6)
    ys = np.round(np.asarray(ys, dtype=float), 6)
    want = brute(xs, ys, list(range(1, len(xs) + 1)), eps)
    got = {r.id: r.cluster_id for r in CL.cluster_dbscan(frame(spark, xs, ys), eps).collect()}
    assert got == want


def test_row_of_three(spark):
    check(spark, [0.0, 0.4, 0.8], [0.0, 0.0, 0.0], CL.eps_from_km(50))
    assert len({r.cluster_id for r in CL.cluster_dbscan(frame(spark, [0.0, 0.4, 0.8], [0, 0, 0]),
                                                          CL.eps_from_km(50)).collect()}) == 1


def test_no_wrap_at_date_line(spark):
    got = CL.cluster_dbscan(frame(spark, [179.9, -179.9], [0.0, 0.0]), CL.eps_from_km(50)).collect()
    assert len({r.cluster_id for r in got}) == 2


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_random_sets(spark, seed):
    rng = np.random.default_rng(seed)
    xs = np.concatenate([rng.uniform(-5, 5, 250), rng.normal(2, 0.05, 60)])
    ys = np.concatenate([rng.uniform(-5, 5, 250), rng.normal(-1, 0.05, 60)])
    check(spark, xs, ys, 0.3)


def test_dense_sets_use_refinement(spark, monkeypatch):
    # a tiny pair budget forces every undecided sub-cell pair through the refinement levels
    monkeypatch.setattr(CL, "POINT_PAIR_BUDGET", 1)
    rng = np.random.default_rng(7)
    xs = np.concatenate([rng.normal(0, 0.2, 200), rng.uniform(-2, 2, 80), [1.0] * 30])
    ys = np.concatenate([rng.normal(0, 0.2, 200), rng.uniform(-2, 2, 80), [1.0] * 30])
    check(spark, xs, ys, 0.05)


def brute_core(xs, ys, eps, k):
    """DBSCAN by its definition: (cluster of each point, or None)."""
    near = [np.nonzero((xs[i] - xs) ** 2 + (ys[i] - ys) ** 2 <= eps * eps)[0] for i in range(len(xs))]
    core = [i for i in range(len(xs)) if len(near[i]) >= k]
    label = {i: i for i in core}
    changed = True
    while changed:
        changed = False
        for i in core:
            low = min(label[int(j)] for j in near[i] if int(j) in label)
            if low < label[i]:
                label[i], changed = low, True
    return [label.get(i, min((label[int(j)] for j in near[i] if int(j) in label), default=None)) for i in range(len(xs))]


@pytest.mark.parametrize("seed,k,eps", [(0, 4, 0.25), (1, 3, 0.15), (2, 9, 0.4)])
def test_core_border_and_noise_against_brute_force(spark, seed, k, eps):
    rng = np.random.default_rng(seed)
    xs = np.round(np.concatenate([rng.uniform(-4, 4, 220), rng.normal(2, 0.07, 60), [1.5] * 12, [3.0, 3.0 + eps, 3.0 + 2 * eps]]), 6)
    ys = np.round(np.concatenate([rng.uniform(-4, 4, 220), rng.normal(-1, 0.07, 60), [1.5] * 12, [9.0] * 3]), 6)
    df = frame(spark, xs, ys).unionByName(spark.createDataFrame([(900, None, Decimal("1"))], "id long, longitude decimal(10,6), latitude decimal(10,6)"))
    out = CL.cluster_dbscan(df, eps, min_points=k)
    assert out.columns == ["id", "longitude", "latitude", "cluster_id"]
    got = {r.id: r.cluster_id for r in out.collect()}
    want = brute_core(xs, ys, eps, k)
    assert got == {i + 1: None if w is None else w + 1 for i, w in enumerate(want)} | {900: None}
    assert None in want and len(set(want)) > 2 and any(w is not None and (np.hypot(xs - xs[i], ys - ys[i]) <= eps).sum() < k for i, w in enumerate(want))


def test_no_core_points_and_no_points(spark):
    assert {r.cluster_id for r in CL.cluster_dbscan(frame(spark, [0.0, 5.0], [0.0, 0.0]), 0.1, min_points=2).collect()} == {None}
    assert CL.cluster_dbscan(frame(spark, [0.0], [0.0]).limit(0), 0.1, min_points=3).count() == 0
    with pytest.raises(ValueError):
        CL.cluster_dbscan(frame(spark, [0.0], [0.0]), 0.1, min_points=0)


@pytest.mark.parametrize("bound", [200_000, 0])
def test_components_by_labels_and_by_stars(spark, monkeypatch, bound):
    """A giant component with a hot middle, a chain, pairs and single nodes, by the shipped labels and by stars."""
    monkeypatch.setattr(CL, "BROADCAST_ROW_LIMIT", bound)
    rng = np.random.default_rng(4)
    edges = [(1000, 1001 + i) for i in range(300)] + [(1001 + i, 2000 + i) for i in range(0, 300, 3)] + [(i, i + 1) for i in range(60)]
    edges += [(5000 + int(a), 5000 + int(b)) for a, b in rng.integers(0, 120, (80, 2))] + [(7, 7), (9000, 8999), (8999, 9000)]
    nodes = sorted({n for e in edges for n in e} | {1, 12345, 777})
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    df = spark.createDataFrame([(n,) for n in nodes], "node long")
    got = CL.connected_components(df, spark.createDataFrame(edges, "na long, nb long")).collect()
    assert len(got) == len(nodes) and {r.node: r.label for r in got} == root


def test_clusters_of_a_graph_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(CL, "BROADCAST_ROW_LIMIT", 0)
    rng = np.random.default_rng(3)
    check(spark, rng.uniform(-6, 6, 200), rng.uniform(-6, 6, 200), 0.6)
