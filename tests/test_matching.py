"""Greedy matching in rounds against the sequential order."""

import random

import numpy as np
import pytest

from siltstone.operators import clusters, matching, nearest
from siltstone.operators.matching import greedy_pairs
from siltstone.operators.nearest import ClusterStats, distances

SCHEMA = "first long, second long, distance double, node long, edge string, n int"


def frame(spark, edges):
    return spark.createDataFrame([(a, b, 0.5, 7, "e", 3) for a, b in edges], SCHEMA).repartition(5)


def sequential(edges):
    taken, found = set(), []
    for a, b in sorted(e for e in edges if None not in e):
        if a != b and a not in taken and b not in taken:
            taken |= {a, b}
            found.append((a, b))
    return found


def got(matched):
    return sorted(map(tuple, matched.collect()))


@pytest.mark.parametrize("last_edges", [0, 40, 10**6])
@pytest.mark.parametrize("seed", [0, 1])
def test_equals_sequential_order(spark, seed, last_edges):
    rng = random.Random(seed)
    nodes, n = rng.choice([(30, 120), (60, 60)])
    edges = [tuple(sorted(rng.sample(range(nodes), 2))) for _ in range(n)]
    assert got(greedy_pairs(frame(spark, edges), last_edges)) == sequential(edges)


def test_hot_node_chain_and_odd_edges(spark):
    star = [(5, 100 + i) for i in range(300)]
    chain = [(1000 + i, 1001 + i) for i in range(12)]
    odd = [(None, 1), (1, None), (7, 7), (9, 8), (8, 9), (9, 8)]
    for edges in (star + chain + odd, chain):
        assert got(greedy_pairs(frame(spark, edges), 20)) == sequential(edges)
    assert got(greedy_pairs(frame(spark, chain), 3)) == sequential(chain)
    assert got(greedy_pairs(frame(spark, []))) == []


def test_accepted_on_executors_equal_those_on_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(3)
    mean = rng.uniform(-4, 4, (60, 2))
    key = np.sort(rng.choice(1000, 60, replace=False)).astype(np.int64)
    stats = ClusterStats(key, np.full(60, 5), mean, mean**2 + rng.uniform(0.1, 1, (60, 2)))
    target = stats.take(np.arange(0, 60, 4))
    for threshold in (0.5, 1.5):
        here = list(clusters.close_pairs(stats, threshold)), list(clusters.first_targets(stats, target, threshold))
        near = list(clusters.first_targets(stats, target, threshold, "nearest"))
        monkeypatch.setattr(clusters, "DRIVER_CLUSTERS", 5)
        there = list(clusters.close_pairs(stats, threshold, spark)), list(clusters.first_targets(stats, target, threshold, "first", spark))
        assert there == here and here[0]
        assert list(clusters.first_targets(stats, target, threshold, "nearest", spark)) == near
        monkeypatch.undo()


def test_candidates_come_in_one_batch(spark):
    """Only batches with pairs leave a task."""
    stats = ClusterStats(np.arange(4), np.full(4, 2), np.array([[0.0], [100.0], [0.5], [200.0]]), np.array([[1.0], [10001.0], [1.25], [40001.0]]))
    assert [(r.first, r.second) for r in clusters.merge_candidates(stats.frame(spark), 1.0).collect()] == [(0, 2)]
    assert clusters.merge_candidates(stats.take(slice(0, 0)).frame(spark), 1.0).collect() == []


@pytest.mark.parametrize("falling", [False, True])
@pytest.mark.parametrize("window_edges", [0, 15, 60])
def test_windows_equal_sequential_order(spark, window_edges, falling):
    rng = random.Random(window_edges)
    edges = [tuple(rng.sample(range(25), 2)) for _ in range(150)]
    edges = edges if falling else [tuple(sorted(e)) for e in edges]
    edges += [(30 + i, 31 + i) for i in range(5)] + [(None, 3)] + edges[:20]
    assert got(greedy_pairs(frame(spark, edges), 3, window_edges)) == sequential(edges)


def tables(monkeypatch):
    names, write = [], matching.written
    monkeypatch.setattr(matching, "written", lambda df, label: names.append(label) or write(df, label))
    return names


def test_many_edges_a_node_and_chains_need_few_rounds(spark, monkeypatch):
    """Of all edges between nodes, or of a chain, only one is the least of both its nodes."""
    names = tables(monkeypatch)
    whole = [(i, j) for i in range(40) for j in range(i + 1, 40)]
    chain = [(i, i + 1) for i in range(120)]
    for edges in (whole, chain, [(j, i) for i, j in whole]):
        names.clear()
        assert got(greedy_pairs(frame(spark, edges), 20)) == sequential(edges)
        assert names.count("edges") <= 3
    names.clear()
    assert got(greedy_pairs(frame(spark, whole), 20, 60)) == sequential(whole)
    assert 3 < names.count("edges") <= 6


def test_pairs_of_clusters_equal_all_computed(spark, monkeypatch):
    rng = np.random.default_rng(5)
    mean = rng.integers(-3, 4, (70, 4)) * 1.0
    mean[60], mean[61, 1], mean[62:64] = np.nan, np.inf, 1e200
    deviation = rng.choice([0.0, 0.5, 1.0, 2.0], (70, 4), p=[0.1, 0.3, 0.3, 0.3])
    with np.errstate(all="ignore"):
        stats = ClusterStats(np.sort(rng.choice(500, 70, replace=False)).astype(np.int64), np.full(70, 5), mean, mean**2 + deviation**2)
        each = [distances(mean, mean[i], stats.deviation[i]) for i in range(70)]
    computed, exact = [], nearest._Bounds.exact
    monkeypatch.setattr(clusters, "EARLIER_CLUSTERS", 16)
    monkeypatch.setattr(clusters, "TASK_PAIRS", 500)
    monkeypatch.setattr(nearest, "CACHED_PAIRS", 7)
    for threshold in (0.0, 1.0, 3.0, 1e9):
        found = clusters.merge_candidates(stats.frame(spark), threshold)
        assert found.rdd.getNumPartitions() == 70**2 // 1000
        expected = {(int(stats.key[i]), int(stats.key[j]), each[i][j]) for i in range(70) for j in range(i + 1, 70) if each[i][j] < threshold}
        assert sorted(map(tuple, found.collect())) == sorted(expected)
    monkeypatch.setattr(nearest._Bounds, "exact", lambda self, points, cluster: computed.append(len(points)) or exact(self, points, cluster))
    far = ClusterStats(stats.key[:60], stats.n[:60], mean[:60] * 3, (mean[:60] * 3) ** 2 + 0.01)
    close = [len(at) for at, _, _ in nearest.close_rows(far.mean, far, 1.0)]
    assert sum(close) == sum(computed) < 200
