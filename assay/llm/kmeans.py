"""Centroid clustering on integers, spared by Hamerly's bounds.

Each vector carries an upper bound of the distance to its centroid and a lower bound of that to
the second nearest. Both are loosened by how far centroids moved; as long as the upper one stays
below, the vector keeps its centroid without a look at the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assay.llm.common import arrow_schema, discard, saved

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Components of larger magnitude have squared distances that a long can't hold.
MOST = 1 << 27
#: Relative slack by which bounds in floating point are moved to the safe side.
SLACK = 1e-14

#: One row a vector; one more a task, without a vector, holds how sums and counts of clusters changed.
STATE = "ints binary, cluster int, upper double, lower double, distance bigint, gained array<bigint>"


def usable(vec: Column, dims: int) -> Column:
    """Exactly dims components, none null or non-finite."""
    whole = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) == dims) & whole, F.lit(False))


def scaled(components: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as integers; fails on a component too large for 64-bit distances."""
    ints = np.floor(scale * components.astype(np.float64))
    if ints.size and np.abs(ints).max() > MOST:
        raise ValueError(f"a component is beyond {MOST // scale}: its squared distances don't fit in 64 bits")
    return ints.astype(np.int64)


def squares(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to one centroid, or to a centroid a row."""
    apart = x - centroid
    return np.einsum("ij,ij->i", apart, apart)


def _above(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 + SLACK)


def _below(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 - SLACK)


def gaps(centroids: np.ndarray) -> np.ndarray:
    """Half the distance from each centroid to its nearest other one, rounded down."""
    if len(centroids) < 2:
        return np.full(len(centroids), np.inf)
    apart = np.stack([squares(centroids, c) for c in centroids])
    np.fill_diagonal(apart, np.iinfo(np.int64).max)
    return _below(apart.min(axis=1)) / 2


def drifts(old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far each centroid moved, and the farthest that any other did, rounded up."""
    own = _above(squares(new, old))
    return own, np.array([np.delete(own, i).max(initial=0.0) for i in range(len(own))])


def assign(
    x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray, gap: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """New clusters and bounds (already loosened when given), and how many vectors were scanned.

    A bound only spares a vector when the upper one is strictly below, so that its centroid is
    the only nearest; all others are held against every centroid in integers, and of equally
    near ones the smaller number wins.
    """
    cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
    limit = np.maximum(lower, gap[cluster])
    left = np.flatnonzero(~(upper < limit))
    upper[left] = _above(squares(x[left], centroids[cluster[left]]))
    left = left[~(upper[left] < limit[left])]
    if len(left):
        apart = np.stack([squares(x[left], c) for c in centroids], axis=1)
        best = apart.argmin(axis=1)
        at = np.arange(len(left))
        nearest = apart[at, best]
        apart[at, best] = np.iinfo(np.int64).max
        cluster[left], upper[left] = best, _above(nearest)
        lower[left] = _below(apart.min(axis=1)) if len(centroids) > 1 else np.inf
    return cluster, upper, lower, len(left)


def _round(frame: DataFrame, schema: str, start: bool, last: bool, moved: tuple, centroids: np.ndarray, scale: int) -> DataFrame:
    """One assignment of all rows: their new state, and a row a task of what clusters gained.

    start: rows are vectors without a state. last: distances to the centroids are given, and what
    clusters gained are their counts and summed distances.
    """
    k, dims = centroids.shape
    own, other = moved
    gap, arrow = gaps(centroids), arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gained = np.zeros((k, 2 if last else dims + 1), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("vec_id")
            if start:
                x = scaled(batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims), scale)
                packed = pa.array([row.tobytes() for row in x.astype("<i4")], type=pa.binary())
                old = np.full(len(x), -1)
                before, upper, lower = np.zeros(len(x), dtype=np.int64), np.full(len(x), np.inf), np.full(len(x), -np.inf)
            else:
                packed = batch.column("ints")
                x = np.frombuffer(b"".join(packed.to_pylist()), dtype="<i4").reshape(-1, dims).astype(np.int64)
                old = before = batch.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64)
                upper = (batch.column("upper").to_numpy(zero_copy_only=False) + own[before]) * (1 + SLACK)
                lower = batch.column("lower").to_numpy(zero_copy_only=False) - other[before]
                lower -= np.abs(lower) * SLACK
            cluster, upper, lower, _ = assign(x, before, upper, lower, centroids, gap)
            distance = squares(x, centroids[cluster]) if last else None
            for c in range(k):
                if last:
                    gained[c] += (cluster == c).sum(), distance[cluster == c].sum()
                    continue
                for rows, sign in (((cluster == c) & (old != c), 1), ((old == c) & (cluster != c), -1)):
                    gained[c, 0] += sign * rows.sum()
                    gained[c, 1:] += sign * x[rows].sum(axis=0)
            n = batch.num_rows
            columns = [
                ids, pa.nulls(n, pa.binary()) if last else packed, pa.array(cluster, type=pa.int32()), pa.array(upper), pa.array(lower),
                pa.array(distance, type=pa.int64()) if last else pa.nulls(n, pa.int64()), pa.nulls(n, arrow.field("gained").type),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        rest = [pa.nulls(1, f.type) for f in arrow][:-1]
        yield pa.RecordBatch.from_arrays([*rest, pa.array([gained.ravel().tolist()], type=arrow.field("gained").type)], schema=arrow)

    return saved(frame.mapInArrow(run, StructType.fromDDL(schema)))


def _gained(state: DataFrame, width: int) -> list[list[int]]:
    """What all tasks' clusters gained together: a few numbers a cluster."""
    rows = state.where("gained IS NOT NULL").select(F.posexplode("gained"))
    total = rows.groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("n")).collect()
    flat = [int(n) for _, n in sorted(total)]
    return [flat[i : i + width] for i in range(0, len(flat), width)]


def first_centroids(vectors: DataFrame, clusters: int, seed: int, scale: int) -> np.ndarray:
    """The vectors whose `seed:id` has the smallest SHA-256; of equal ids the one with the smallest
    components. A vector without an id is never one."""
    named = vectors.where("vec_id IS NOT NULL").withColumn("name", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    rows = named.orderBy("name", "vec").limit(clusters).collect()
    return scaled(np.array([r["vec"] for r in rows], dtype=np.float64), scale)


def cluster(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
    dims: int = DIMS, scale: int = SCALE, seed: int = SEED,
) -> DataFrame:
    """Each usable vector's cluster, squared distance and what its cluster came to.

    Vectors that are null, of another length, or hold a null or non-finite component take no
    part. Repeated rows are vectors of their own; a vector without an id is clustered but is never
    a first centroid. With fewer vectors than clusters there are fewer centroids; without any the
    result is empty. A tie goes to the smaller number; a cluster that lost its vectors stays where
    it was. Other columns are ignored. A component beyond 131,072 fails the job, as its squared
    distances don't fit in a long.

    Every round is one pass without a shuffle: state in, state out. Changes of the clusters' sums
    come out of the same pass, a row a task, so the driver sees but a few numbers a cluster.
    """
    vectors = df.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec")).where(usable(F.col("vec"), dims))
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, {STATE}"
    centroids = first_centroids(vectors, clusters, seed, scale)
    ends = f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not len(centroids):
        return df.sparkSession.createDataFrame([], ends)
    state, still = vectors, (np.zeros(len(centroids)), np.zeros(len(centroids)))
    sums = [[0] * (dims + 1) for _ in centroids]
    moved = still
    for i in range(rounds):
        before, state = state, _round(state, schema, i == 0, False, moved, centroids, scale)
        if i:
            discard(before)
        sums = [[a + b for a, b in zip(*both)] for both in zip(sums, _gained(state, dims + 1))]
        new = np.array([[s // n for s in total] if n else old for (n, *total), old in zip(sums, centroids.tolist())], dtype=np.int64)
        moved, centroids = drifts(centroids, new), new
        state = state.where("gained IS NULL")
    last = _round(state, schema, rounds == 0, True, moved, centroids, scale)
    if rounds:
        discard(state)
    inertia = [d for _, d in _gained(last, 2)]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    known = df.sparkSession.createDataFrame(
        [(i, d, sum(inertia), name) for i, (d, name) in enumerate(zip(inertia, names))],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    found = last.where("gained IS NULL").select("vec_id", "cluster", "distance")
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
