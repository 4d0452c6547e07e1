"""Nearest clusters by bounds, and probes of large filters, against computing everything."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.operators import nearest
from siltstone.operators.bloom import bloom_build, bloom_probe
from siltstone.operators.nearest import ClusterStats, distances, nearest_rows


def every(points, stats, threshold, pick):
    """One cluster after the other."""
    best, row = np.full(len(points), np.inf), np.full(len(points), -1, np.int64)
    spread = stats.deviation if threshold is not None else [None] * len(stats)
    for i in range(len(stats)):
        with np.errstate(all="ignore"):
            d = distances(points, stats.mean[i], spread[i])
        closer = d < best
        if threshold is not None:
            closer = (d < threshold) & (row < 0) if pick == "first" else closer & (d < threshold)
        best[closer], row[closer] = d[closer], i
    return row, best


def clusters(mean, deviation):
    mean, deviation = np.asarray(mean, float), np.asarray(deviation, float)
    return ClusterStats(np.arange(len(mean)), np.full(len(mean), 3), mean, mean**2 + deviation**2)


def same(points, stats, threshold, pick="nearest"):
    got, expected = nearest_rows(points, stats, threshold, pick), every(points, stats, threshold, pick)
    assert got[0].tolist() == expected[0].tolist()
    assert got[1].tolist() == expected[1].tolist()


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32 - 1), st.sampled_from([1, 3, 16]), st.sampled_from([1, 4, 40]), st.sampled_from([1e-9, 1.0, 1e6]))
def test_same_clusters_and_distances(seed, d, k, scale):
    rng = np.random.default_rng(seed)
    # Coordinates on a coarse grid, so that there are ties and equal points, far from the origin.
    mean = (rng.integers(-4, 5, (k, d)) + rng.choice([0, 1000])) * scale
    points = (rng.integers(-4, 5, (30, d)) + rng.choice([0, 1000])) * scale
    deviation = rng.choice([0.0, 0.5, 1.0, 2.0], (k, d), p=[0.1, 0.3, 0.3, 0.3]) * scale
    stats = clusters(mean, deviation)
    same(points, stats, None)
    for threshold in (0.5, 2.0, float(np.sqrt(d)), 1e9):
        same(points, stats, threshold)
        same(points, stats, threshold, "first")


def test_no_numbers_and_huge_ones():
    points = np.array([[np.nan, 0.0], [np.inf, 1.0], [1e200, -1e200], [0.0, 0.0], [1e-200, 0.0]])
    for stats in (clusters([[0, 0], [1e200, 0], [5, 5]], [[1, 1], [1, 1], [0, 1]]), clusters(np.zeros((0, 2)), np.zeros((0, 2)))):
        same(points, stats, None)
        same(points, stats, 3.0)
        same(points, stats, 3.0, "first")
    same(points[:0], clusters([[0, 0]], [[1, 1]]), None)


@pytest.mark.parametrize("numbers", [1, 700])
def test_small_tiles(monkeypatch, numbers):
    monkeypatch.setattr(nearest, "TILE_NUMBERS", numbers)
    rng = np.random.default_rng(4)
    same(rng.normal(0, 1, (50, 8)), clusters(rng.normal(0, 1, (30, 8)), rng.uniform(0.5, 2, (30, 8))), 3.5)
    same(rng.normal(0, 1, (50, 8)), clusters(np.zeros((30, 8)), np.ones((30, 8))), None)


def test_few_distances_are_computed():
    rng = np.random.default_rng(1)
    points, stats = rng.normal(0, 1, (2000, 64)), clusters(rng.normal(0, 1, (300, 64)), rng.uniform(0.5, 2, (300, 64)))
    for threshold, pick in ((None, "nearest"), (12.0, "nearest"), (9.0, "first")):
        bounds = nearest._Bounds(stats, threshold)
        computed = sum(len(at) for at, _ in bounds.candidates(points, pick))
        most = len(points) * (1.01 if pick == "nearest" else 300)
        assert computed <= most
        same(points, stats, threshold, pick)


def test_probe_of_a_filter_too_large_to_broadcast(spark):
    seen = spark.createDataFrame([(f"u{i}",) for i in range(300)] + [(None,), ("",)], "name string")
    rows = [(i, f"u{i % 600}") for i in range(900)] + [(i, None) for i in range(300)] + [(i, "") for i in range(20)] + [(5, "u1")] * 500
    probe = spark.createDataFrame(rows, "key int, name string").repartition(5)
    bloom = bloom_build(seen, "name", 50_021, 7)
    one, other = (sorted(map(repr, bloom_probe(probe, "name", bloom, 50_021, 7, words).collect())) for words in (0, 10**6))
    assert one == other and len(one) == len(rows)
    plan = bloom_probe(probe, "name", bloom, 50_021, 7, 10**6)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
