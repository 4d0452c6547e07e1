import json

from pyspark.sql import functions as F

from siltstone.operators.bfr import bfr
from siltstone.operators.exploration import top_words
from siltstone.sources import readers, schemas, writers


def lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(rows))
    return str(path)


def read_back(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


def test_json_reviews(spark, tmp_path):
    path = lines(tmp_path / "r.json", [
        json.dumps({"review_id": "r", "stars": 4.0, "extra": 1}), "not json", "", '{"review_id": "cut',
        json.dumps({"review_id": "odd", "stars": "many", "text": "t"}),
    ])
    rows = readers.read_reviews(spark, path)
    first, odd = rows.orderBy(F.desc("review_id")).collect()
    assert first.review_id == "r" and first.stars == 4.0 and first.text is None
    # JSON of another type than the schema's is no broken line.
    assert (odd.review_id, odd.stars, odd.text) == ("odd", None, "t")
    assert rows.count() == 2
    assert [tuple(r) for r in readers.count_bad_json(spark, path).collect()] == [("r.json", 2)]


def test_json_businesses(spark, tmp_path):
    path = lines(tmp_path / "b.json", ['{"business_id": "b", "categories": null, "city": "Wien"}'])
    assert tuple(readers.read_businesses(spark, path).first()) == ("b", None, "Wien")


def test_points(spark, tmp_path):
    lines(tmp_path / "in" / "b.txt", ["3,1.5,-2", "4,1e2,0", "x,1,2", "5,one,2", "6", "7,1,,2"])
    lines(tmp_path / "in" / "a.txt", ["1, 0.5, 1", "", "2,2,2"])
    points = readers.read_points(spark, str(tmp_path / "in"))
    got = {(r.chunk, r.id): r.vec for r in points.collect()}
    assert got == {
        ("a.txt", 1): [0.5, 1.0], ("a.txt", 2): [2.0, 2.0],
        ("b.txt", 3): [1.5, -2.0], ("b.txt", 4): [100.0, 0.0],
    }
    bad = readers.count_bad_points(spark, str(tmp_path / "in")).collect()
    assert [tuple(r) for r in bad] == [("b.txt", 4)]
    assert readers.point_files(spark, str(tmp_path / "in")) == ["a.txt", "b.txt"]


def test_points_of_another_length(spark, tmp_path):
    lines(tmp_path / "in" / "a.txt", ["1,0,0", "2,1,1,9", "3,5", "4,5,5"])
    points = readers.read_points(spark, str(tmp_path / "in"), dimensions=2)
    assert sorted(r.id for r in points.collect()) == [1, 4]
    bad = readers.count_bad_points(spark, str(tmp_path / "in"), dimensions=2).collect()
    assert [tuple(r) for r in bad] == [("a.txt", 2)]


def test_unique_points(spark):
    rows = [(1, [0.0], "a"), (1, [5.0], "b"), (1, [3.0], "a"), (2, [1.0], "a"), (2, [1.0], "a")]
    points = spark.createDataFrame(rows, "id bigint, vec array<double>, chunk string")
    for parts in (1, 5):
        got = readers.unique_points(points.repartition(parts)).orderBy("id").collect()
        assert [tuple(r) for r in got] == [(1, [5.0], "b"), (2, [1.0], "a")]


def test_stop_words(spark, tmp_path):
    path = lines(tmp_path / "stop", ["the", " a\t", "", "été"])
    stop = readers.read_stop_words(spark, path)
    assert {r.word for r in stop.collect()} == {"the", "a", "été"}
    text = spark.createDataFrame([("The dog a dog",)], "text string")
    assert [tuple(r) for r in top_words(text, "text", stop, 5).collect()] == [("dog", 2)]


def test_lines_to_rows(spark):
    frame = spark.createDataFrame([(1, '{"city": "Rom"}'), (2, "{")], "n int, value string")
    rows = readers.parse_json_lines(frame, schemas.BUSINESS_EVENT).collect()
    assert [(r.n, r.city) for r in rows] == [(1, "Rom")]


def test_bfr_from_files_to_files(spark, tmp_path):
    rows = [f"{i},{(i % 2) * 50 + (i % 7) * 0.1},{(i % 5) * 0.1}" for i in range(200)]
    lines(tmp_path / "in" / "p0.csv", rows[:100])
    lines(tmp_path / "in" / "p1.csv", rows[100:])
    found = bfr(readers.read_points(spark, str(tmp_path / "in")), 2, 3.0)
    writers.write_rounds(found.rounds, str(tmp_path / "rounds"))
    written = read_back(tmp_path / "rounds").splitlines()
    assert written[0] == (
        "round_id,nof_cluster_discard,nof_point_discard,"
        "nof_cluster_compression,nof_point_compression,nof_point_retained"
    )
    assert [line.split(",")[0] for line in written[1:]] == ["1", "2"]
    writers.write_labels(found.labels, str(tmp_path / "labels"))
    labels = [json.loads(line) for line in read_back(tmp_path / "labels").splitlines()]
    assert {r["id"] for r in labels} == {str(i) for i in range(200)}


def test_other_writers(spark, tmp_path):
    document = spark.createDataFrame([('{"A": 1}',)], "document string")
    writers.write_document(document, str(tmp_path / "d"))
    assert json.loads(read_back(tmp_path / "d")) == {"A": 1}
    found = spark.createDataFrame([("k", 1), ("l", 0)], "key string, prediction int")
    writers.write_predictions(found, str(tmp_path / "p"))
    assert sorted(read_back(tmp_path / "p").splitlines()) == ["k 1", "l 0"]
    writers.write_json(found, str(tmp_path / "j"))
    assert len(read_back(tmp_path / "j").splitlines()) == 2


def test_chunk_filter_prunes_files(spark, tmp_path):
    lines(tmp_path / "in" / "a.txt", ["1,1"])
    lines(tmp_path / "in" / "b.txt", ["2,1"])
    points = readers.read_points(spark, str(tmp_path / "in")).filter("chunk = 'b.txt'")
    assert [r.id for r in points.collect()] == [2]
    scan = points._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1
