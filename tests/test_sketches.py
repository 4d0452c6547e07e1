import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltstone.operators import bloom, distinct, sampling
from siltstone.functions import hashing


def frame_of(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def signature(value, buckets=5000, hashes=7):
    x = int.from_bytes(value.encode(), "big")
    fixed = [83, 96, 44, 82, 25, 5, 101]
    more = [a for a in range(2, 60) if a not in fixed]
    return {((a * x + 83) % 233333333333) % buckets for a in (fixed + more)[:hashes]}


def plain_predictions(seen, probed, buckets=5000, hashes=7):
    bits = set().union(*[signature(v, buckets, hashes) for v in seen if v])
    return [int(bool(v) and signature(v, buckets, hashes) <= bits) for v in probed]


SEEN = [f"city {i}" for i in range(60)] + ["Zürich", "東京", "", None]
PROBED = [f"city {i}" for i in range(0, 300)] + ["Zürich", "東京", "Paris", "", None]


@pytest.fixture
def joins(spark):
    """Shuffled joins instead of broadcasts, as for filters beyond the session's threshold."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    yield lambda shuffled: spark.conf.set(name, "-1" if shuffled else before)
    spark.conf.set(name, before)


@pytest.mark.parametrize("buckets,hashes", [(5000, 7), (200, 3), (64, 1), (100_000, 12)])
@pytest.mark.parametrize("by_join", [False, True])
def test_bloom(spark, joins, buckets, hashes, by_join):
    joins(by_join)
    built = bloom.bloom_build(frame_of(spark, SEEN), "v", buckets, hashes)
    bits = set().union(*[signature(v, buckets, hashes) for v in SEEN if v])
    assert {r.position for r in bloom.bloom_positions(built).collect()} == bits
    got = bloom.bloom_probe(frame_of(spark, PROBED), "v", built, buckets, hashes)
    found = [r.prediction for r in got.orderBy("i").collect()]
    assert found == plain_predictions(SEEN, PROBED, buckets, hashes)
    assert all(found[:60])  # no false negative


def test_bloom_of_nothing(spark):
    empty = frame_of(spark, [None, ""])
    built = bloom.bloom_build(empty, "v")
    assert bloom.bloom_positions(built).count() == 0
    got = bloom.bloom_probe(frame_of(spark, ["x"]), "v", built)
    assert [r.prediction for r in got.collect()] == [0]


def test_bloom_probe_by_join_keeps_repeated_records(spark, joins):
    joins(True)
    built = bloom.bloom_build(frame_of(spark, ["hot"]), "v")
    got = bloom.bloom_probe(frame_of(spark, ["hot"] * 500 + ["cold"] * 100 + [None] * 50), "v", built)
    assert Counter((r.v, r.prediction) for r in got.collect()) == {("hot", 1): 500, ("cold", 0): 100, (None, 0): 50}


BASE = datetime(2024, 1, 1)


def plain_windows(rows, length, slide):
    result = {}
    for ts, value in rows:
        if not value:
            continue
        seconds = int((ts - datetime(1970, 1, 1)).total_seconds())
        start = seconds // slide * slide
        while start > seconds - length:
            end = datetime(1970, 1, 1) + timedelta(seconds=start + length)
            result.setdefault(str(end), set()).add(value)
            start -= slide
    return result


def runs(values):
    def zeros(h):
        digits = format(h, "b").zfill(20)
        return len(digits) - len(digits.rstrip("0"))

    return [
        max(zeros((a * int.from_bytes(v.encode(), "big") + b) % hashing.FM_P) for v in values)
        for a, b in zip(hashing.FM_A, hashing.FM_B)
    ]


@pytest.mark.parametrize("length,slide", [(30, 10), (10, 10), (25, 10), (60, 7)])
def test_windows(spark, length, slide):
    generator = random.Random(length)
    rows = [
        (BASE + timedelta(seconds=generator.randint(0, 90)), generator.choice(["x", "yé", "z", "w", "", None]))
        for _ in range(60)
    ]
    frame = spark.createDataFrame(rows, "ts timestamp, v string")
    expected = plain_windows(rows, length, slide)
    exact = distinct.window_distinct(frame, "ts", "v", length, slide).collect()
    assert {r.time: r.ground_truth for r in exact} == {t: len(s) for t, s in expected.items()}
    bits = distinct.fm_window_bits(frame, "ts", "v", length, slide).collect()
    assert {r["time"]: [r[z] for z in distinct.ZERO_COLUMNS] for r in bits} == {
        t: runs(s) for t, s in expected.items()
    }
    both = distinct.fm_windows(frame, "ts", "v", length, slide, "fixed").collect()
    alone = distinct.fm_estimates(frame, "ts", "v", length, slide, "fixed").collect()
    assert {(r.time, r.estimation) for r in both} == {(r.time, r.estimation) for r in alone}
    with pytest.raises(ValueError):
        distinct.fm_windows(frame, "ts", "v", length, slide, "other")


def test_repeats_change_nothing(spark):
    rows = [(BASE, "a"), (BASE, "b")]
    once = spark.createDataFrame(rows, "ts timestamp, v string")
    often = spark.createDataFrame(rows * 50, "ts timestamp, v string")
    a, b = [
        sorted(map(tuple, distinct.fm_windows(f, "ts", "v", 30, 10).collect())) for f in (once, often)
    ]
    assert a == b and len(a) == 3


def test_reservoir_sizes(spark):
    few = spark.range(5)
    assert {r.id for r in sampling.reservoir(few, "id", 100).collect()} == set(range(5))
    assert sampling.reservoir(spark.range(1000), "id", 100).count() == 100


def test_reservoir_is_uniform_over_seeds(spark):
    hits = Counter()
    for seed in range(60):
        hits.update(r.id for r in sampling.reservoir(spark.range(50), "id", 10, seed).collect())
    # Expected 12 hits each with deviation 3.1.
    assert len(hits) == 50 and min(hits.values()) >= 2 and max(hits.values()) <= 26


def test_samples_of_parts_merge_exactly(spark):
    whole = sampling.reservoir(spark.range(1000), "id", 20, 4)
    parts = [
        sampling.reservoir(spark.range(low, low + 250), "id", 20, 4) for low in range(0, 1000, 250)
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    merged = sampling.reservoir(union, "id", 20, 4)
    assert {r.id for r in merged.collect()} == {r.id for r in whole.collect()}


def test_popular_tags_keep_ties(spark):
    tags = ["a"] * 5 + ["b"] * 5 + ["c"] * 3 + ["d"] * 2 + ["e"]
    sample = spark.createDataFrame([([t],) for t in tags], "tags array<string>")
    got = [tuple(r) for r in sampling.popular_tags(sample, "tags").collect()]
    assert got == [("a", 5), ("b", 5), ("c", 3), ("d", 2)]


def test_tags_of_structs(spark):
    rows = [([("x",), ("y",)],), ([],), (None,)]
    frame = spark.createDataFrame(rows, "hashtags array<struct<text: string>>")
    named = frame.withColumn("tags", sampling.tag_texts(F.col("hashtags")))
    assert [r.tags for r in sampling.tagged(named, "tags").collect()] == [["x", "y"]]


def test_topic_filter(spark):
    rows = [(1, "en", "Covid19 news"), (2, "de", "covid19"), (3, "en", "nothing"), (4, "en", None)]
    frame = spark.createDataFrame(rows, "id int, lang string, text string")
    got = sampling.topic_filter(frame, "text", ["COVID19", "Wuhan"], "lang")
    assert [r.id for r in got.collect()] == [1]
