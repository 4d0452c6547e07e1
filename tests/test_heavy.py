"""Exact heavy hitters and places of rows."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.operators import exploration, positions
from siltstone.operators.heavy import Summary, heavy_keys, heavy_top, heavy_words
from siltstone.operators.positions import with_place


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefgh"), max_size=30), min_size=1, max_size=12), st.integers(1, 5))
def test_error_bounds_every_count(batches, capacity):
    own, truth = Summary(capacity), Counter()
    for batch in batches:
        own.add(pa.array(batch, pa.string()))
        truth.update(batch)
    found = own.reduce()
    counters = dict(zip(found.column("key").to_pylist(), found.column("n").to_pylist()))
    assert len(counters) <= capacity and own.error * (capacity + 1) <= truth.total()
    assert all(counters.get(key, 0) <= n <= counters.get(key, 0) + own.error for key, n in truth.items())


def skewed(n, seed=1):
    rng = np.random.default_rng(seed)
    keys = [f"k{min(int(x), 3000)}" for x in rng.zipf(1.3, n)] + [None] * (n // 3) + ["hot"] * (n // 3)
    random.Random(seed).shuffle(keys)
    return keys


def counts_of(rows):
    return [(r[0], r["count"]) for r in rows.collect()]


@pytest.mark.parametrize("capacity, proved", [(4096, True), (40, True), (2, False)])
def test_top_equals_full_count(spark, capacity, proved):
    keys = skewed(6000)
    df = spark.createDataFrame([(k, 1) for k in keys], "key string, n int").repartition(6)
    found = heavy_top(df, "key", 12, capacity, attempts=2 if proved else 1)
    expected = sorted(Counter(keys).items(), key=lambda e: (-e[1], e[0] is not None, e[0] or ""))[:12]
    assert counts_of(found.rows) == expected
    assert (found.error is not None) == proved


@pytest.mark.parametrize("capacity", [4096, 30, 1])
def test_frequent_keys_equal_full_count(spark, capacity):
    keys = [k and int(k[1:]) if k != "hot" else -1 for k in skewed(4000, 2)]
    df = spark.createDataFrame([(k,) for k in keys], "supplier bigint").repartition(5)
    for n in (0, 25, 10**6):
        found = heavy_keys(df, "supplier", n, capacity, attempts=1)
        assert dict(counts_of(found.rows)) == {k: c for k, c in Counter(keys).items() if c > n}


def test_ties_at_the_end_of_the_answer(spark):
    df = spark.createDataFrame([(f"w{i:03d}",) for i in range(300) for _ in range(3)] + [("top",)] * 9, "key string").repartition(4)
    for capacity in (5, 50, 500):
        assert counts_of(heavy_top(df, "key", 4, capacity).rows) == [("top", 9), ("w000", 3), ("w001", 3), ("w002", 3)]
    assert heavy_top(df.limit(0), "key", 4).rows.collect() == []
    assert len(heavy_top(df, "key", 1000, 5000).rows.collect()) == 301


def test_words(spark):
    df = spark.createDataFrame([("The cat, the cat! a dog",), ("cat (dog) the",), (None,), ("",)], "text string")
    found = heavy_words(df, "text", ["the", "a", None], 3)
    assert counts_of(found.rows) == [tuple(r) for r in exploration.top_words(df, "text", ["the", "a"], 3).collect()]
    assert counts_of(found.rows)[0] == ("cat", 3)


def placed(rows, by, order):
    groups = {}
    for row in rows:
        groups.setdefault(by(row), []).append(row)
    return sorted((*row, i) for own in groups.values() for i, row in enumerate(sorted(own, key=order)))


@pytest.mark.parametrize("bound", [0, 10**6])
def test_places_equal_row_number(spark, monkeypatch, bound):
    monkeypatch.setattr(positions, "BROADCAST_MAX_ROWS", bound)
    rng = random.Random(3)
    rows = [(rng.choice([0, 0, 0, 0, 1, 2, 77]), i) for i in rng.sample(range(10_000), 800)]
    df = spark.createDataFrame(rows, "cluster int, id bigint").repartition(7)
    got = sorted(map(tuple, with_place(df, ["cluster"], ["id"]).collect()))
    assert got == placed(rows, lambda r: r[0], lambda r: r[1])
    whole = sorted(map(tuple, with_place(df, [], [F.desc("id")]).collect()))
    assert whole == placed(rows, lambda r: 0, lambda r: -r[1])


def test_places_of_null_and_equal_rows(spark):
    rows = [(None, 5)] * 400 + [(None, None)] * 3 + [(1, None), (1, 2)]
    df = spark.createDataFrame(rows, "cluster int, id bigint").repartition(3)
    got = with_place(df, ["cluster"], [F.asc_nulls_first("id")]).collect()
    null = sorted((r.place, r.id) for r in got if r.cluster is None)
    assert [p for p, _ in null] == list(range(403)) and [i for _, i in null] == [None] * 3 + [5] * 400
    assert sorted((r.place, r.id) for r in got if r.cluster == 1) == [(0, None), (1, 2)]
    assert with_place(df.limit(0), ["cluster"], ["id"]).collect() == []
    with pytest.raises(ValueError):
        with_place(df.withColumnRenamed("id", "_AT"), ["cluster"], ["_AT"])
