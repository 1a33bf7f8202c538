"""Clustering against brute force over whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from pressgauge.llm import centroids
from pressgauge.session import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def plain(rows, k, rounds, dim, scale):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [v for _, v in order[:k]]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(assign(v)[1], []).append(v)
        centers = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centers)]
    found = [(i, *assign(v)[::-1]) for i, v in kept]
    sums = {n: sum(d for _, c, d in found if c == n) for n in range(len(centers))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, c, d, sums[c], sum(sums.values()), digest[c]) for i, c, d in found), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def got(df):
    rows = [tuple(r)[:6] for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("seed", range(4))
def test_clusters(spark, seed):
    rng = random.Random(seed)
    dim, k = rng.choice([(3, 5), (8, 16), (2, 4)])
    middles = [[rng.uniform(-2, 2) for _ in range(dim)] for _ in range(4)]
    rows = [(i, [m + rng.gauss(0, 0.2 if seed else 0.0) for m in rng.choice(middles)]) for i in range(300)]
    rows += [(1000, None), (1001, [1.0] * (dim - 1)), (1002, [None] + [0.5] * (dim - 1)), (1003, [float("nan")] * dim), (1004, [float("-inf")] * dim)]
    rows += [rows[0], rows[0], (None, [0.25] * dim), (None, [-0.3] * dim), (7, [0.0] * dim), (1005, [-0.0] * dim), (1006, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = centroids.clusters_with_inertia(vectors, k=k, rounds=3, dim=dim, scale=64, pivots=3)
    assert got(found) == plain(rows, k, 3, dim, 64)


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(3)
    middles = rng.integers(-5000, 5000, (12, 16))
    vectors = middles[rng.integers(0, 12, 4000)] + rng.integers(-40, 40, (4000, 16))
    centers = middles + rng.integers(-9, 9, middles.shape)
    simplex = centroids.Simplex.of(centers, 6)
    assert len(simplex.pivots) == 6
    squares = ((vectors[:, None, :] - centers[None]) ** 2).sum(axis=2)
    a, c = simplex.apexes(simplex.squares(vectors)), simplex.apexes(simplex.squares(centers))
    flat = ((a[:, None, :-1] - c[None, :, :-1]) ** 2).sum(axis=2)
    assert (flat + (a[:, None, -1] - c[None, :, -1]) ** 2 <= squares * (1 + 1e-6) + 1).all()
    assert (flat + (a[:, None, -1] + c[None, :, -1]) ** 2 >= squares * (1 - 1e-6) - 1).all()
    cluster, distance, compared = centroids.nearest(vectors, a, centers, c)
    assert (cluster == squares.argmin(axis=1)).all() and (distance == squares.min(axis=1)).all()
    assert compared.mean() < len(centers) / 2


def test_flat_pivots():
    """Vectors on a line give two pivots, equal vectors one."""
    line = np.outer(np.arange(20), np.arange(1, 6))
    assert len(centroids.Simplex.of(line, 8).pivots) == 2
    assert len(centroids.Simplex.of(np.ones((5, 3), np.int64), 8).pivots) == 1


def test_empty_extra_and_too_large(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster string, distance string, v string")
    assert centroids.clusters_with_inertia(frame([])).count() == 0
    assert centroids.clusters_with_inertia(frame([(1, [0.5] * 63, "x", "y", "z")])).columns[0] == "vec_id"
    one = centroids.clusters_with_inertia(frame([(1, [0.5] * 64, "x", "y", "z")])).collect()
    assert [(r["vec_id"], r["cluster"], r["distance"], r["inertia"]) for r in one] == [(1, 0, 0, 0)]
    with pytest.raises(Exception, match="64 bits"):
        centroids.clusters_with_inertia(frame([(1, [1e9] * 64, "x", "y", "z")])).collect()
