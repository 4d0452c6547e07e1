"""Clustering of chunk files on a stream against the batch form."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators.bfr import Limits, bfr
from siltstone.sources import readers
from siltstone.streaming.bfr import ChunkedBfr, stream_points

LIMITS = Limits(sample_points=10_000, sample_share=0.5)
K, ALPHA = 3, 2.0


def lines(chunk, n=60):
    rng = random.Random(chunk)
    centres = [(-40, -40), (0, 30), (50, 0), (90, 90)][: 3 + (chunk > 0)]
    made = []
    for i in range(n):
        x, y = rng.choice(centres) if rng.random() < 0.95 else (rng.uniform(-300, 300), rng.uniform(-300, 300))
        made.append(f"{chunk * n + i},{rng.gauss(x, 1)!r},{rng.gauss(y, 1)!r}")
    return [*made, "no point", ""]


def put(path, names):
    path.mkdir(exist_ok=True)
    for chunk, name in enumerate(names):
        (path / name).write_text("\n".join(lines(chunk)))


def batch(spark, path):
    return bfr(readers.read_points(spark, str(path), 2), K, ALPHA, chunks=readers.point_files(spark, str(path)), limits=LIMITS)


def same(one, other):
    assert [tuple(r) for r in one.rounds.orderBy("round_id").collect()] == [tuple(r) for r in other.rounds.orderBy("round_id").collect()]
    assert sorted(map(tuple, one.labels.collect())) == sorted(map(tuple, other.labels.collect()))
    tops = [[(r.set, r.cluster, r.n) for r in each.summaries.orderBy("cluster").collect()] for each in (one, other)]
    assert tops[0] == tops[1] and tops[0]


NAMES = ["data-0.csv", "data-1.csv", "data-10.csv"]


def run(writer):
    query = writer.start()
    query.awaitTermination(240)
    assert query.exception() is None


@pytest.fixture(scope="module")
def expected(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("whole")
    put(path, NAMES)
    found = batch(spark, path)
    assert found.rounds.count() == 3
    return found


def test_files_of_one_batch_in_name_order(spark, tmp_path, expected):
    put(tmp_path / "in", NAMES)
    found = ChunkedBfr(str(tmp_path / "state"), K, ALPHA, limits=LIMITS)
    run(found.writer(stream_points(spark, str(tmp_path / "in"), 2), str(tmp_path / "cp"), None))
    same(found.result(spark), expected)


def test_stopped_between_chunks_and_batches_run_again(spark, tmp_path, expected):
    found = ChunkedBfr(str(tmp_path / "state"), K, ALPHA, limits=LIMITS)
    for chunk, name in enumerate(NAMES):
        part = spark.createDataFrame([(line,) for line in lines(chunk)], "value string").withColumn("chunk", F.lit(name))
        points = readers.parse_points(part, 2)
        for _ in range(1 + (chunk == 1)):
            # A new object knows nothing but the folder; the second run stands for one that broke off.
            ChunkedBfr(str(tmp_path / "state"), K, ALPHA, limits=LIMITS).fold(points, chunk)
        if chunk == 1:
            assert found.result(spark).rounds.count() == 2
    same(found.result(spark), expected)
    same(found.result(spark), expected)
    assert not list((tmp_path / "state" / "points").glob("batch=*/*"))


def test_batches_without_points(spark, tmp_path):
    empty = spark.createDataFrame([], "id bigint, vec array<double>, chunk string")
    found = ChunkedBfr(str(tmp_path), K, ALPHA, limits=LIMITS)
    found.fold(empty, 0)
    assert found.result(spark).rounds.collect() == [] and found.result(spark).labels.collect() == []
    points = spark.createDataFrame([(i, [float(i % 3) * 50, 0.1 * i], "a") for i in range(30)], empty.schema)
    found.fold(points, 1)
    found.fold(empty, 2)
    assert found.result(spark).rounds.count() == 1 and found.result(spark).labels.count() == 30


def test_chunks_by_folder(spark, tmp_path):
    for name in ("b", "a"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0").write_text(f"{ord(name)},1.0,2.0\n")
    stream = stream_points(spark, f"{tmp_path}/*", 2, by_folder=True)
    seen = []
    run(stream.writeStream.foreachBatch(lambda df, n: seen.extend(df.collect())).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True))
    assert sorted((r.id, r.vec, r.chunk) for r in seen) == [(97, [1.0, 2.0], "a"), (98, [1.0, 2.0], "b")]
