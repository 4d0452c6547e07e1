"""The sample in the state store against the batch sample."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import sampling
from siltstone.streaming import reservoir

ROW = "event_id bigint, tags array<string>, at timestamp, n int"


def rows(n=700):
    made = [(None if i % 3 == 0 else i % 12 if i % 7 == 0 else i, [f"t{i % 9}", f"u{i % 4}"] if i % 10 else [], i) for i in range(n)]
    random.Random(2).shuffle(made)
    return made


def frame(spark, part):
    df = spark.createDataFrame([(i, tags, n) for i, tags, n in part], "event_id bigint, tags array<string>, n int")
    return df.select("event_id", "tags", F.timestamp_micros(F.col("n") * 1_000_003).alias("at"), "n")


@pytest.mark.parametrize("cuts", [(), (5, 30, 400)])
def test_equals_batch_after_cuts_and_restarts(spark, tmp_path, cuts):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    made = rows()
    # Equal rows without an id are one draw; every copy of them counts.
    made += [(None, ["same"], -1)] * 5
    whole = sampling.tagged(frame(spark, made), "tags")
    for number, (low, high) in enumerate(zip((0, *cuts), (*cuts, len(made)))):
        frame(spark, made[low:high]).coalesce(2).write.parquet(f"{tmp_path}/in/{number}")
        stream = spark.readStream.schema(ROW).parquet(f"{tmp_path}/in/*")
        query = reservoir.start_reservoir(stream, "event_id", "tags", f"{tmp_path}/state", 60, 5, shards=4, interval=None)
        query.awaitTermination(240)
        assert query.exception() is None
    expected = sampling.reservoir(whole, "event_id", 60, 5)
    got = reservoir.sample_now(spark, f"{tmp_path}/state", ROW)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect())) and got.count() == 60
    found = reservoir.reports(spark, f"{tmp_path}/state")
    last = found.agg(F.max("batch")).first()[0]
    report = [r for r in found.collect() if r.batch == last]
    assert {r.seen for r in report} <= {whole.count()} or len(cuts)
    assert {(r.tag, r["count"]) for r in report} == {tuple(r) for r in sampling.popular_tags(expected, "tags").collect()}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_fewer_records_than_places_and_none(spark, tmp_path):
    frame(spark, [(1, ["a"], 1), (None, ["a", None], 2), (3, None, 3), (4, [], 4)]).write.parquet(f"{tmp_path}/in/0")
    stream = spark.readStream.schema(ROW).parquet(f"{tmp_path}/in/*")
    reservoir.start_reservoir(stream, "event_id", "tags", f"{tmp_path}/s", 10, interval=None).awaitTermination(240)
    assert sorted(r.n for r in reservoir.sample_now(spark, f"{tmp_path}/s", ROW).collect()) == [1, 2]
    assert [(r.seen, r.tag, r["count"]) for r in reservoir.reports(spark, f"{tmp_path}/s").collect()] == [(2, "a", 2)]
