"""Exact search: repeated ids, huge components, pruning, brute force on Spark."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import topk


def brute(rows, k, wanted):
    """Every query row's list, as (query_id, rank, vec_id, score)."""
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x * 256) for x in v)]
    out = []
    for a, (i, v) in enumerate(whole):
        if wanted(i):
            scored = [(topk.clipped(sum(x * y for x, y in zip(v, w))), j) for b, (j, w) in enumerate(whole) if b != a and len(w) == len(v)]
            out += [(i, n + 1, j, s) for n, (s, j) in enumerate(sorted(scored, key=lambda r: (-r[0], r[1]))[:k])]
    return sorted(out)


def search(spark, rows, k):
    v = topk.quantise(spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id bigint, embedding array<double>, row string, v string"))
    return sorted(map(tuple, topk.top_k(v, F.col("id") % 50 == 0, k).collect()))


def test_repeated_ids_and_rows(spark):
    rng = random.Random(1)
    rows = [(rng.choice([0, 50, 50, 50, 1, 2, 3, 100]), [rng.choice([-1.0, 0.5, 1.0]) for _ in range(4)]) for _ in range(60)]
    rows += [(50, [1.0] * 4), (50, [1.0] * 4), (7, None), (None, [1.0] * 4)]
    got = search(spark, rows, 3)
    assert got == brute(rows, 3, lambda i: i % 50 == 0)


def test_huge_components(spark):
    rows = [(0, [1e300, -1e18]), (1, [1e300, 1.0]), (2, [-1e300, 3.0]), (3, [0.5, 1e18]), (50, [2.0, 1e15]), (4, [1e308, 0.0]), (5, [1e-300, 2.0**60])]
    got = search(spark, rows, 4)
    assert got == brute(rows, 4, lambda i: i % 50 == 0)
    assert (0, 1, 1, 2**63 - 1) in got and all(-(2**63) <= r[3] < 2**63 for r in got)


def test_search_equals_brute_force_over_many_blocks(spark, monkeypatch):
    for name, size in (("CANDIDATE_BLOCK", 70), ("QUERY_BLOCK", 3), ("CHUNK", 16)):
        monkeypatch.setattr(topk, name, size)
    rng = np.random.default_rng(2)
    rows = [(int(i) * 5, (rng.normal(size=16) * rng.choice([0.1, 3])).tolist()) for i in range(400)] + [(i, rng.normal(size=8).tolist()) for i in range(0, 300, 50)]
    assert search(spark, rows, 5) == brute(rows, 5, lambda i: i % 50 == 0)


def test_clustered_vectors_are_pruned_level_by_level():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 64)) * np.linspace(3, 0.1, 64)
    x = np.floor(256 * (centres[rng.integers(20, size=6000)] + 0.05 * rng.normal(size=(6000, 64))))
    q, seen = x[:50], []
    turn = topk.turning(x[::7])
    assert np.allclose(turn @ turn.T, np.eye(64), atol=1e-9)
    row, at, score = topk.best_of_block(q, x, np.arange(50), 5, turn, seen)
    full = q @ x.T
    full[np.arange(50), np.arange(50)] = -np.inf
    want = np.argsort(-full, axis=1, kind="stable")[:, :5]
    assert at.reshape(50, 5).tolist() == want.tolist() and score.tolist() == np.take_along_axis(full, want, 1).ravel().astype(int).tolist()
    shares = np.mean(seen, axis=0)
    print("shares left after each level", shares)
    assert (np.diff(shares) <= 1e-12).all() and shares[-1] < 0.25


def test_levels_bound_the_score_after_turning():
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(80, 64)) * 100)
    t = x @ topk.turning(x)
    for n in topk.levels(64):
        f = topk.segment_features(t, n)
        assert (f @ f.T >= x @ x.T - 1e-6).all()
