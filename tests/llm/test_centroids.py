"""Clustering against plain loops over all centroids."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from riskmill.llm import centroids


def plain_clusters(rows, k=8, rounds=10, size=64):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    mark = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    means = [v for _, v in sorted(kept, key=mark)[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    assign = lambda: [min((far(v, c), n) for n, c in enumerate(means)) for _, v in kept]
    for _ in range(rounds):
        near = assign()
        for n in range(len(means)):
            own = [v for (_, v), (_, c) in zip(kept, near) if c == n]
            if own:
                means[n] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    inertia = [sum(d for d, c in near if c == n) for n in range(len(means))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in means]
    return sorted(((i, c, d, inertia[c], sum(inertia), sha[c]) for (i, _), (d, c) in zip(kept, near)), key=repr)


@pytest.mark.parametrize("many,k,size", [(300, 8, 3), (200, 5, 64), (40, 1, 2), (60, 8, 1)])
def test_nearest_equals_all_distances(many, k, size):
    rng = np.random.default_rng(many)
    vectors, means = rng.integers(-4, 5, (many, size)), rng.integers(-3, 4, (k, size))
    number, distance, compared = centroids.nearest(vectors, means)
    exact = ((vectors[:, None] - means[None]) ** 2).sum(axis=2)
    assert (number == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all() and (compared <= k).all()


def test_walk_stops_before_far_centroids():
    means = np.array([[1000 * i, 1000 * i] for i in range(8)])
    number, _, compared = centroids.nearest(np.array([[3001, 2999]]), means)
    assert number[0] == 3 and compared[0] < 8


def test_edges_and_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(120)]
    rows += [(7, rows[8][1]), (7, rows[8][1]), (None, rows[3][1]), (200, None), (201, []), (202, [1.0] * 63), (203, [None] + [1.0] * 63),
             (204, [float("nan")] * 64), (205, [float("inf")] * 64), (206, [0.0] * 64), (207, [-0.0001] * 64)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<double>, cluster int").repartition(3)
    got = sorted((tuple(r) for r in centroids.cluster_report(frame).collect()), key=repr)
    assert got == plain_clusters(rows)
    few = frame.filter("vec_id in (206, 207)")
    assert sorted((tuple(r) for r in centroids.cluster_report(few).collect()), key=repr) == plain_clusters(rows[-2:])
    assert centroids.cluster_report(frame.limit(0)).count() == 0
