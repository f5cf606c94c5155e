from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from metroscope.llm.ball_tree import bounds_of_levels, build_tree, inner_products, search, top_inner_products

SCHEMA = "vec_id long, embedding array<float>, label int, row string, query long, score long, shard string, dim int"


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def brute(rows, k):
    whole = [(i, [math.floor(1024 * x) for x in np.array(v, dtype=np.float32).astype(float).tolist()]) for i, v in rows if usable(v)]
    out = []
    for a, (i, v) in enumerate(whole):
        if i is None or i % 4:
            continue
        scores = [(-max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(v, w)))), j is None, j) for b, (j, w) in enumerate(whole) if b != a and len(v) == len(w)]
        out += [(i, rank, j, -s) for rank, (s, _, j) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def found(spark, rows, **sizes):
    vectors = spark.createDataFrame([(i, v, None, "x", k, k, "s", 1) for k, (i, v) in enumerate(rows)], SCHEMA)
    return sorted(map(tuple, top_inner_products(vectors, F.coalesce(F.col("vec_id") % 4 == 0, F.lit(False)), **sizes).collect()), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 40, "block_queries": 7, "leaf_rows": 4}])
def test_against_brute_force(spark, sizes):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(size=6) * rng.choice([0.05, 1, 30])).tolist()) for k in range(300)]
    rows += [(1000 + k, [0.5, 0.25, 0.0, 1.0, -1.0, 2.0]) for k in range(30)]  # copies: ties by number
    rows += [(4, [0.5] * 6), (None, [0.5] * 6), (None, [9.0] * 6), (4, [0.5] * 6)]  # numbers twice or unknown
    rows += [(2000, None), (2004, [None, 1.0, 1.0, 1.0, 1.0, 1.0]), (2008, [float("nan")] * 6), (2012, [float("inf")] * 6), (2016, [])]
    rows += [(3000 + k, [float(k), 1.0]) for k in range(5)] + [(3100, [1.0] * 9)]  # other lengths: few or no other rows
    assert found(spark, rows, k=10, **sizes) == brute(rows, 10)


def test_scores_beyond_64_bits(spark):
    rows = [(k, [(-1.0) ** k * 10.0 ** (3 * k), 1.0]) for k in range(12)]
    assert found(spark, rows, k=3, shard_rows=5, leaf_rows=2) == brute(rows, 3)


def test_empty(spark):
    assert found(spark, []) == [] and found(spark, [(0, None)]) == [] and found(spark, [(1, [1.0])]) == []


def test_tree_prunes_and_loses_nothing(monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8)) * 4000
    vectors = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 8)) * 20)
    order, middles, radii = build_tree(vectors, 32)
    assert sorted(order.tolist()) == list(range(4000))
    for level, edges in enumerate(bounds_of_levels(4000, 32)):
        for k, (first, last) in enumerate(zip(edges[:-1], edges[1:])):
            assert np.linalg.norm(vectors[order[first:last]] - middles[level][k], axis=1).max() <= radii[level][k] + 1e-6
    tree = {"vectors": vectors[order], "row": order, "vec_id": order, "unnamed": np.zeros(4000, bool), "depth": np.array([len(middles)]), "leaf_rows": np.array([32]),
            **{f"centres{k}": c for k, c in enumerate(middles)}, **{f"radii{k}": r for k, r in enumerate(radii)}}
    seen = []

    monkeypatch.setattr("metroscope.llm.ball_tree.inner_products", lambda a, b: (seen.append(len(a) * len(b)), inner_products(a, b))[1])
    best = search(tree, vectors[:50], np.arange(50), np.full(50, -(1 << 63)), 10)
    scores = inner_products(vectors[:50], vectors)
    scores[np.arange(50), np.arange(50)] = -(1 << 62)
    assert (best.score == -np.sort(-scores, axis=1)[:, :10]).all()
    assert sum(seen) < 50 * 4000 / 4  # most leaves are never looked at
