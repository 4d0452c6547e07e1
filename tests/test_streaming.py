import pytest
from pyspark.sql import functions as F

from siltstone.operators import distinct, sampling
from siltstone.operators.bloom import bloom_build, bloom_probe
from siltstone.plans.samples import tagged_events
from siltstone.sources import readers, schemas
from siltstone.streaming import distinct as stream_distinct
from siltstone.streaming import membership
from siltstone.streaming import sampling as stream_sampling

FOLDER = "/root/testdata/sf0.001"
HOUR = 3600


def run(writer):
    query = writer.start()
    query.awaitTermination(180)
    assert query.exception() is None
    query.stop()


def events_dir(spark, path, parts=3):
    """Events as JSON files, one per time range, so that batches arrive in order."""
    events = spark.read.parquet(f"{FOLDER}/events.parquet").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "props"
    )
    n = events.count()
    for i in range(parts):
        low, high = i * n // parts, (i + 1) * n // parts
        part = events.filter((F.col("event_id") >= low) & (F.col("event_id") < high))
        part.coalesce(1).write.json(f"{path}/part{i}")
    return events, "event_id bigint, ts timestamp, user_id bigint, event_type string, props string"


def stream_of(spark, path, schema):
    return readers.stream_json(spark, f"{path}/*", schema, maxFilesPerTrigger="1")


def put(spark, path, rows):
    spark.createDataFrame(rows, "ts string, city string").coalesce(1).write.json(str(path))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("exact", [True, False])
def test_windows_equal_batch(spark, tmp_path, exact, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        events, schema = events_dir(spark, tmp_path / "in")
        source = stream_of(spark, tmp_path / "in", schema)
        state, csv = str(tmp_path / "state"), str(tmp_path / "csv")
        args = ("ts", "user_id", 30 * HOUR, 10 * HOUR)
        run(stream_distinct.stream_windows(source, *args, state, str(tmp_path / "cp"), exact, "fixed", csv, None))
        got = stream_distinct.window_rows(spark, state, 30 * HOUR, 10 * HOUR, exact, "fixed")
        batch = distinct.fm_windows(events, *args, "fixed").select(*got.columns)
        expected = sorted(map(tuple, batch.collect()))
        assert sorted(map(tuple, got.collect())) == expected
        assert sorted(map(tuple, stream_distinct.read_csv(spark, csv, exact).select(*got.columns).collect())) == expected
        assert len(expected) > 60
        # A time without zone has the same windows.
        plain = spark.read.parquet(f"{FOLDER}/events.parquet")
        assert sorted(map(tuple, distinct.fm_windows(plain, *args, "fixed").select(*got.columns).collect())) == (
            expected if zone == "UTC" else sorted(map(tuple, utc_windows(spark, plain, args, got.columns)))
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def utc_windows(spark, plain, args, columns):
    """Windows of the same wall times, labelled in UTC."""
    as_utc = plain.withColumn("ts", F.to_utc_timestamp(F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp"), "UTC"))
    return distinct.fm_windows(as_utc, *args, "fixed").select(*columns).collect()


def test_late_rows_are_counted(spark, tmp_path):
    source, state, checkpoint = str(tmp_path / "in" / "*"), str(tmp_path / "state"), str(tmp_path / "cp")
    csv = str(tmp_path / "csv")

    def once():
        stream = readers.stream_json(spark, source, "ts timestamp, city string")
        run(stream_distinct.stream_windows(stream, "ts", "city", 30, 10, state, checkpoint, True, "fixed", csv, None))

    batches = [
        [("2024-01-01 00:00:01", "x"), ("2024-01-01 00:05:00", "y")],
        [("2024-01-01 01:00:00", "z"), (None, "no time"), ("2024-01-01 01:00:00", "")],
        [("2024-01-01 00:00:02", "an hour late"), ("2024-01-01 00:00:03", "x")],
    ]
    for name, rows in zip("abc", batches):
        put(spark, tmp_path / "in" / name, rows)
        once()
    everything = spark.createDataFrame(sum(batches, []), "ts string, city string").withColumn("ts", F.col("ts").cast("timestamp"))
    expected = sorted(map(tuple, distinct.fm_windows(everything, "ts", "city", 30, 10, "fixed").collect()))
    got = stream_distinct.window_rows(spark, state, 30, 10, True, "fixed")
    assert sorted(map(tuple, got.collect())) == expected
    assert sorted(map(tuple, stream_distinct.read_csv(spark, csv).collect())) == expected
    assert dict((t, n) for t, n, _ in expected)["2024-01-01 00:00:10"] == 2


def test_repeated_window_batch_changes_nothing(spark, tmp_path):
    fold = stream_distinct.fold_panes(str(tmp_path), "ts", "city", 30, 10, True, "fixed")
    frame = spark.createDataFrame([("2024-01-01 00:00:01", "x")], "ts string, city string")
    for number in (0, 1, 1):
        fold(frame, number)
    assert [tuple(r)[1] for r in stream_distinct.window_rows(spark, str(tmp_path), 30, 10).collect()] == [1, 1, 1]


def test_windows_by_arrival(spark, tmp_path):
    for name in "ab":
        put(spark, tmp_path / "in" / name, [("1999-01-01 00:00:00", name), ("1999-01-01 00:00:00", "both")])
    stream = readers.stream_json(spark, str(tmp_path / "in" / "*"), "ts timestamp, city string", maxFilesPerTrigger="1")
    state = str(tmp_path / "state")
    year = 366 * 24 * HOUR
    run(stream_distinct.stream_windows(stream, None, "city", year, year, state, str(tmp_path / "cp"), interval=None))
    rows = stream_distinct.window_rows(spark, state, year, year).collect()
    assert max(r.ground_truth for r in rows) == 3 and all(r.time > "2020" for r in rows)


def test_bloom_on_a_stream(spark, tmp_path):
    events, schema = events_dir(spark, tmp_path / "in", parts=2)
    names = spark.createDataFrame([("1",), ("7",), ("9",), (None,), ("",)], "name string")
    membership.save_bloom(names, "name", str(tmp_path / "bloom"))
    keyed = F.col("user_id").cast("string").alias("user")
    source = stream_of(spark, tmp_path / "in", schema).select("event_id", keyed)
    found = membership.stream_predictions(source, "user", str(tmp_path / "bloom"))
    writer = membership.write_predictions(found, str(tmp_path / "out"), str(tmp_path / "cp"))
    run(writer.trigger(availableNow=True))
    got = spark.read.schema("event_id bigint, user string, prediction int").csv(
        str(tmp_path / "out"), sep=" "
    )
    batch = bloom_probe(events.select("event_id", keyed), "user", bloom_build(names, "name"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert {r.user for r in got.filter("prediction = 1").collect()} >= {"1", "7", "9"}


def test_reservoir_on_a_stream_equals_batch(spark, tmp_path):
    events = tagged_events(spark, FOLDER).withColumn(
        "tags", F.when(F.col("event_id") % 5 == 0, F.array().cast("array<string>")).otherwise(F.col("tags"))
    )
    for i in range(5):
        part = events.filter(F.floor(F.col("event_id") / 200) == i)
        part.coalesce(1).write.json(str(tmp_path / "in" / f"part{i}"))
    source = stream_of(spark, tmp_path / "in", "event_id bigint, tags array<string>")
    folder = str(tmp_path / "state")
    writer = stream_sampling.stream_reservoir(source, "event_id", "tags", folder, 100, 5)
    run(writer.trigger(availableNow=True))
    expected = sampling.reservoir(sampling.tagged(events, "tags"), "event_id", 100, 5)
    got = stream_sampling.last_sample(spark, folder)
    assert {r.event_id for r in got.collect()} == {r.event_id for r in expected.collect()}
    report = stream_sampling.read_report(spark, folder)
    last = report.filter("batch = 4").collect()
    assert {r.seen for r in last} == {800}
    assert {(r.tag, r["count"]) for r in last} == {
        tuple(r) for r in sampling.popular_tags(expected, "tags").collect()
    }


def test_repeated_batch_writes_the_same_version(spark, tmp_path):
    folder = str(tmp_path)
    fold = stream_sampling.fold_batch(folder, "id", "tags", 3, 1)
    frames = [
        spark.createDataFrame([(i, ["a", str(i)]) for i in range(b * 10, b * 10 + 10)],
                              "id bigint, tags array<string>")
        for b in range(2)
    ]
    fold(frames[0], 0)
    fold(frames[1], 1)
    first = sorted(map(str, stream_sampling.read_sample(spark, folder, 1).collect()))
    fold(frames[1], 1)
    assert sorted(map(str, stream_sampling.read_sample(spark, folder, 1).collect())) == first
    assert spark.read.parquet(stream_sampling.seen_path(folder, 1)).first()["seen"] == 20


def test_json_stream_with_nested_tags(spark, tmp_path):
    lines = [
        '{"id": 1, "lang": "en", "text": "Stay home", "entities": {"hashtags": [{"text": "x"}, {"text": "y"}]}}',
        '{"id": 2, "lang": "en", "text": "nothing", "entities": {"hashtags": []}}',
        '{"id": 3, "lang": "de", "text": "stay home", "entities": {"hashtags": [{"text": "z"}]}}',
        '{"id": 4, "lang": "en", "text": "STAY"}',
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    lines_stream = spark.readStream.text(str(tmp_path / "in"))
    tweets = readers.parse_json_lines(lines_stream, schemas.TWEET)
    on_topic = sampling.topic_filter(tweets, "text", ["stay"], "lang")
    with_tags = sampling.tagged(
        on_topic.withColumn("tags", sampling.tag_texts(F.col("entities.hashtags"))), "tags"
    )
    out = str(tmp_path / "out")
    run(
        with_tags.select("id", "tags").writeStream.format("json").option("path", out)
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
    )
    rows = spark.read.schema("id bigint, tags array<string>").json(out).collect()
    assert [(r.id, r.tags) for r in rows] == [(1, ["x", "y"])]
