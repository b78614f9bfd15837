import hashlib
import math
import random

import numpy as np
import pytest

from assay.llm import kmeans
from tests.llm import data

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
SCHEMA = "vec_id bigint, embedding array<double>, cluster string, ints int"


def plain(rows, dims, clusters=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in named[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for k, vs in groups.items():
            centroids[k] = [sum(x) // len(vs) for x in zip(*vs)]
    ends = [(i, *nearest(v)) for i, v in kept]
    per = {}
    for _, d, k in ends:
        per[k] = per.get(k, 0) + d
    for i, d, k in ends:
        yield i, k, d, per[k], sum(per.values()), hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()


def rows(dims, seed=1, count=400):
    r = random.Random(seed)
    middles = [[r.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    found = [(i, [x + r.gauss(0, 0.3) for x in middles[i % 5]]) for i in range(count)]
    # Many on a grid, so that distances tie; copies, and rows that take no part.
    found += [(1000 + i, [r.choice([-0.5, 0.0, 0.5]) for _ in range(dims)]) for i in range(count)]
    odd = [None, [], [0.1] * (dims - 1), [0.1] * (dims + 1), [None] * dims, [math.nan] * dims, [math.inf] + [0.0] * (dims - 1)]
    return [*found, *found[:7], (3, found[9][1]), (None, found[11][1]), (None, None), *[(2000 + i, v) for i, v in enumerate(odd)]]


def frame(spark, given):
    return spark.createDataFrame([(*r, "x", 1) for r in given], SCHEMA).repartition(3)


@pytest.mark.parametrize(("dims", "clusters", "rounds"), [(64, 8, 10), (2, 8, 10), (1, 3, 4), (2, 1, 2), (3, 40, 6), (2, 8, 0)])
def test_clusters(spark, dims, clusters, rounds):
    given = rows(dims)
    found = kmeans.cluster(frame(spark, given), dims=dims, clusters=clusters, rounds=rounds)
    data.same(found, COLUMNS, plain(given, dims, clusters, rounds))


def test_few_and_none(spark):
    few = [(1, [0.25, 1.0]), (2, [0.25, 1.0]), (3, [-1.0, 0.0])]
    data.same(kmeans.cluster(frame(spark, few), dims=2), COLUMNS, plain(few, 2))
    assert kmeans.cluster(frame(spark, [(1, None)]), dims=2).count() == 0
    assert kmeans.cluster(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        kmeans.cluster(frame(spark, [(1, [1e9, 0.0])]), dims=2).count()


def test_bounds_spare_scans():
    """Bounds give what full scans give, and spare most of them."""
    r = np.random.default_rng(0)
    middles = r.integers(-3000, 3000, (6, 16))
    x = np.concatenate([m + r.integers(-200, 200, (500, 16)) for m in middles])
    centroids, scanned = middles + r.integers(-400, 400, middles.shape), []
    cluster, upper, lower = np.zeros(len(x), dtype=np.int64), np.full(len(x), np.inf), np.full(len(x), -np.inf)
    for _ in range(6):
        cluster, upper, lower, n = kmeans.assign(x, cluster, upper, lower, centroids, kmeans.gaps(centroids))
        scanned.append(n)
        assert (cluster == np.stack([kmeans.squares(x, c) for c in centroids]).argmin(axis=0)).all()
        new = centroids + r.integers(-20, 20, centroids.shape)
        own, other = kmeans.drifts(centroids, new)
        upper, lower, centroids = upper + own[cluster], lower - other[cluster], new
    assert sum(scanned[1:]) < len(x) / 20
