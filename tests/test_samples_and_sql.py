"""Samples over dirty ids, bitmaps, and functions in SQL texts."""

import random
import statistics

import pytest

from siltstone.functions.hashing import BLOOM_P, text_mod
from siltstone.functions.sql import register
from siltstone.operators import exploration, sampling
from siltstone.operators.bloom import bloom_build, bloom_positions
from siltstone.operators.kmeans import start_points
from siltstone.streaming import sampling as stream_sampling

ROW = "event_id bigint, tags array<string>, n int"


def dirty(n=900):
    """A third without an id, a third that share few ids, a third with their own."""
    return [(None if i % 3 == 0 else i % 15 if i % 3 == 1 else i, [f"t{i % 7}"], i) for i in range(n)]


def test_rows_without_id_are_drawn_like_others(spark):
    df = spark.createDataFrame(dirty(), ROW).repartition(6)
    shares = [
        sum(r.event_id is None for r in sampling.reservoir(df.where("event_id IS NULL OR n % 3 = 2"), "event_id", 100, seed).collect())
        for seed in range(12)
    ]
    # Half of those rows have no id.
    assert 40 <= statistics.mean(shares) <= 60 and len(set(shares)) > 3


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(dirty(), ROW)
    samples = [sorted(map(repr, sampling.reservoir(df.repartition(p), "event_id", 100, 5).collect())) for p in (1, 4, 9)]
    assert samples[0] == samples[1] == samples[2] and len(samples[0]) == 100


@pytest.mark.parametrize("cuts", [(1,), (4, 300, 500)])
def test_stream_equals_batch_on_dirty_ids(spark, tmp_path, cuts):
    rows = dirty()
    random.Random(1).shuffle(rows)
    fold = stream_sampling.fold_batch(str(tmp_path), "event_id", "tags", 100, 5)
    for number, (low, high) in enumerate(zip((0, *cuts), (*cuts, len(rows)))):
        fold(spark.createDataFrame(rows[low:high], ROW), number)
    got = stream_sampling.last_sample(spark, str(tmp_path))
    expected = sampling.reservoir(spark.createDataFrame(rows, ROW), "event_id", 100, 5)
    assert sorted(map(repr, got.select("event_id", "tags", "n").collect())) == sorted(map(repr, expected.collect()))


def test_start_points_without_id(spark):
    points = spark.createDataFrame([(None if i % 3 else i, [float(i), 0.0]) for i in range(300)], "id bigint, vec array<double>")
    drawn = [sum(r.id is None for r in start_points(points, 60, seed).collect()) for seed in range(6)]
    assert 30 <= statistics.mean(drawn) <= 50
    assert start_points(points, 60, 1).collect() == start_points(points.repartition(5), 60, 1).collect()


def test_bitmaps_equal_distinct_counts(spark):
    rows = [(i % 70_000 - 3, None if i % 5 == 0 else i * 40_000, f"{1995 + i % 4}-01-02") for i in range(0, 200_000, 7)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "review bigint, user bigint, date string").repartition(4)
    args = ("review", "user", "date", 1996)
    assert exploration.review_summary_bitmaps(df, *args).collect() == exploration.review_summary(df, *args).collect()
    empty = df.limit(0)
    assert exploration.review_summary_bitmaps(empty, *args).collect() == exploration.review_summary(empty, *args).collect()
    plan = exploration.review_summary_bitmaps(df, *args)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_functions_in_sql(spark):
    assert set(register(spark)) >= {"comma_items", "bloom_signature", "distinct_runs"}
    texts = spark.createDataFrame([("éa",), ("",), (None,), ("x" * 500,), ("A, b ,c",)], "t string")
    found = spark.sql("SELECT t, text_remainder(t) AS r, bloom_signature(t) AS s, distinct_runs(t) AS z, text_tokens(t) AS w FROM {d}", d=texts).collect()
    by_text = {r.t: r for r in found}
    assert by_text["éa"].r == 12822881 and by_text[""].s is None and by_text[None].z is None
    assert {r.t: r.r for r in found} == {r.t: r.m for r in texts.select("t", text_mod("t", BLOOM_P).alias("m")).collect()}
    for text in ("éa", "x" * 500):
        own = bloom_positions(bloom_build(spark.createDataFrame([(text,)], "t string"), "t")).collect()
        assert set(by_text[text].s) == {r[0] for r in own} and len(by_text[text].z) == 12
    assert by_text["A, b ,c"].w == ["a,", "b", ",c"]
    items = spark.sql("SELECT item FROM {d}, LATERAL comma_items(t) WHERE t LIKE 'A%'", d=texts).collect()
    assert [r.item for r in items] == ["A", "b", "c"]
    assert spark.sql("SELECT strip_punctuation('(a.b)!') AS p, text_year('1997-05-01') AS y").first() == ("ab", "1997")
    plan = spark.sql("SELECT bloom_signature(t) AS s FROM {d}", d=texts)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
