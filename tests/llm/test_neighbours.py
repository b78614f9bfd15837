import math
import random

import numpy as np
import pytest

from assay.llm import neighbours
from tests.llm import data

COLUMNS = ["query_id", "rank", "vec_id", "score"]
SCHEMA = "vec_id bigint, embedding array<double>, score string, row int"


def plain(rows, nearest=20, every=20):
    kept = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    for a, (query, q) in enumerate(kept):
        if query is None or query % every:
            continue
        found = []
        for b, (i, v) in enumerate(kept):
            if a != b and len(v) == len(q):
                score = 0.0
                for x, y in zip(q, v):
                    score += x * y
                found.append((-score, -1 if i is None else i))
        for rank, (score, i) in enumerate(sorted(found)[:nearest], 1):
            yield query, rank, None if i < 0 else i, -score


def rows(dims=16, count=700, seed=2):
    r = random.Random(seed)
    found = [(i, [r.gauss(0.3, 1) * (1 + i % 3) for _ in range(dims)]) for i in range(count)]
    # Ties by copies and by a grid; other lengths; rows that take no part.
    found += [(1000 + i, [float(r.choice([-1, 0, 1])) for _ in range(dims)]) for i in range(100)]
    found += [(2000 + i, found[40][1]) for i in range(30)] + [(3000 + i, [r.random() for _ in range(3)]) for i in range(50)] + [(4000, [1.5])]
    odd = [None, [], [0.0] * dims, [None] + [1.0] * (dims - 1), [math.nan] + [1.0] * (dims - 1), [math.inf] * dims]
    return [*found, *found[:3], (None, found[5][1]), (None, None), *[(5000 + 20 * i, v) for i, v in enumerate(odd)]]


def frame(spark, given):
    return spark.createDataFrame([(*r, "x", 1) for r in given], SCHEMA).repartition(3)


@pytest.mark.parametrize("blocks", [None, (64, 64)])
def test_neighbours(spark, blocks, monkeypatch):
    if blocks:
        monkeypatch.setattr(neighbours, "VECTORS_A_BLOCK", (100, 200))
        monkeypatch.setattr(neighbours, "QUERIES_A_BLOCK", (5, 9))
        monkeypatch.setattr(neighbours, "FIRST_SCORED", 24)
    given = rows()
    # With a bound this wide nothing is missed, so rows must be those of a full search, ties and all.
    data.same(neighbours.search(frame(spark, given), deviations=8), COLUMNS, plain(given))


def test_recall(spark):
    """Production bounds, wide vectors with and without a common direction: nearly all neighbours found."""
    r = np.random.default_rng(1)
    for shift in (0.0, 2.0):
        x = r.standard_normal((3000, 64)) + shift
        given = [(i, v.tolist()) for i, v in enumerate(x)]
        got = {(q["query_id"], q["vec_id"]) for q in neighbours.search(frame(spark, given)).collect()}
        product = x[::20] @ x.T
        product[np.arange(150), np.arange(0, 3000, 20)] = -np.inf
        want = {(20 * i, int(j)) for i, row in enumerate(product) for j in np.argsort(-row)[:20]}
        assert len(got) == 3000 and len(got & want) >= 0.99 * len(want)


def test_codes_estimate():
    """Estimates are within the bound, and within a third of it mostly; two thirds of the vectors needn't be scored."""
    r = np.random.default_rng(3)
    x, q = r.standard_normal((4000, 64)) * 3, r.standard_normal(64)
    turn = neighbours.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    centre = x.mean(axis=0)
    codes, factor, bound = neighbours.encode(x, centre, turn)
    assert codes.shape == (4000, 16)
    signs = np.unpackbits(codes, axis=1) * 2.0 - 1
    estimate = (signs @ (q @ turn)) * factor + q @ centre
    off = np.abs(estimate - x @ q) / (bound * np.sqrt(q @ q))
    assert (off <= 1).mean() > 0.999 and np.median(off) < 0.34
    best = np.sort(x @ q)[-20]
    assert (estimate + bound * np.sqrt(q @ q) >= best).mean() < 1 / 3


def test_nothing(spark):
    assert neighbours.search(spark.createDataFrame([], SCHEMA)).count() == 0
    assert neighbours.search(frame(spark, [(0, [1.0, 2.0])])).count() == 0
    assert neighbours.search(frame(spark, [(1, [1.0]), (2, [2.0])])).count() == 0
    assert neighbours.search(frame(spark, [(0, [1.0]), (2, [2.0])])).collect()[0]["score"] == 2.0
