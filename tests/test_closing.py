"""Windows that close: each once, late values kept, state bounded, repeated micro-batches the same."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siltstone.operators import distinct
from siltstone.sources import readers
from siltstone.streaming.closing import ClosingWindows

LENGTH, SLIDE, DELAY = 30, 10, 15
SCHEMA = "at bigint, city string"


def batches_of(seed, n=12, size=12):
    """Times rise with the batches, with some rows far behind."""
    rng = random.Random(seed)
    made = []
    for k in range(n):
        rows = [(k * 9 + rng.randint(0, 20) - (rng.randint(30, 200) if rng.random() < 0.15 else 0), f"c{rng.randint(0, 8)}") for _ in range(size)]
        made.append([*rows, (None, "no time"), (k * 9, None), (k * 9, "")] if k != 5 else [(None, "x")])
    return made


def ends(second):
    return [e for e in range((second // SLIDE) * SLIDE + LENGTH, second, -SLIDE) if e - LENGTH <= second < e]


def simulated(batches):
    """Windows as they close, late values, and what is open at the end."""
    content, closed, late = defaultdict(set), {}, set()
    watermark = None
    for rows in batches:
        good = [(t, c) for t, c in rows if t is not None and c]
        for t, c in good:
            for e in ends(t):
                if watermark is not None and e <= watermark:
                    late.add((e, c))
                content[e].add(c)
        times = [t for t, _ in good]
        if times:
            watermark = max(times) - DELAY if watermark is None else max(watermark, max(times) - DELAY)
            for e in content:
                if e <= watermark and e not in closed and not all((e, c) in late for c in content[e]):
                    closed[e] = len(content[e])
    return closed, late, content, watermark


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).select(F.timestamp_seconds("at").alias("ts"), "city")


def second(time):
    import datetime

    return int(datetime.datetime.fromisoformat(time).replace(tzinfo=datetime.timezone.utc).timestamp())


def batch_rows(spark, batches, columns):
    whole = frame(spark, sum(batches, []))
    return sorted(map(tuple, distinct.fm_windows(whole, "ts", "city", LENGTH, SLIDE, "fixed").select(*columns).collect()))


def test_windows_close_once_and_late_values_correct_them(spark, tmp_path):
    batches = batches_of(1)
    found = ClosingWindows(str(tmp_path), "ts", "city", LENGTH, SLIDE, DELAY, compact_every=4)
    for number, rows in enumerate(batches):
        found.fold(frame(spark, rows), number)
    closed, late, content, watermark = simulated(batches)
    out = [(second(r.time), r.ground_truth) for r in found.closed(spark, "fixed").collect()]
    assert len(out) == len({e for e, _ in out}) and dict(out) == closed
    assert {(second(r.time), r.value) for r in found.late(spark).collect()} == late and late
    opened = {second(r.time): r.ground_truth for r in found.open(spark, "fixed").collect()}
    assert opened == {e: len(c) for e, c in content.items() if e > watermark}
    columns = ["time", "ground_truth", "estimation"]
    assert sorted(map(tuple, found.rows(spark, "fixed").select(*columns).collect())) == batch_rows(spark, batches, columns)


def test_repeated_batches_change_nothing(spark, tmp_path):
    batches = batches_of(3, 7)
    once = ClosingWindows(f"{tmp_path}/once", "ts", "city", LENGTH, SLIDE, DELAY, compact_every=3)
    again = ClosingWindows(f"{tmp_path}/again", "ts", "city", LENGTH, SLIDE, DELAY, compact_every=3)
    for number, rows in enumerate(batches):
        once.fold(frame(spark, rows), number)
        for _ in range(2):
            again.fold(frame(spark, rows), number)
    for name in ("closed", "late", "rows"):
        one, other = (sorted(map(tuple, getattr(each, name)(spark).collect())) for each in (once, again))
        assert one == other and one


def test_estimates_without_values(spark, tmp_path):
    batches = batches_of(4, 7)
    found = ClosingWindows(str(tmp_path), "ts", "city", LENGTH, SLIDE, DELAY, exact=False, compact_every=3)
    for number, rows in enumerate(batches):
        found.fold(frame(spark, rows), number)
    assert sorted(map(tuple, found.rows(spark, "fixed").select("time", "estimation").collect())) == batch_rows(spark, batches, ["time", "estimation"])
    assert found.late(spark).count() > 0


def test_state_is_bounded_on_a_long_stream(spark, tmp_path):
    """Rows stored after any micro-batch: the panes between watermark and latest time, and few micro-batches."""
    found = ClosingWindows(str(tmp_path), "ts", "city", 4, 2, 1, archive=False, compact_every=4)
    stored = []
    for number in range(25):
        found.fold(frame(spark, [(3 * number + k, f"c{c}") for k in range(3) for c in range(5)]), number)
        now = found.progress(spark)
        names = [p.name for p in (tmp_path / "delta").iterdir() if p.name.startswith("batch=")]
        stored.append((found._panes(spark, now.base, now.batch).count(), len(names)))
    assert max(rows for rows, _ in stored) <= 5 * 3 * 6 and max(folders for _, folders in stored) <= 4 + 3
    assert stored[12:16] == stored[20:24]
    assert len([p for p in (tmp_path / "base").iterdir() if p.name.startswith("batch=")]) <= 3
    with pytest.raises(ValueError):
        found.corrected(spark)


def test_a_stream_stopped_between_files(spark, tmp_path):
    batches = batches_of(5, 4)
    found = ClosingWindows(f"{tmp_path}/state", "ts", "city", LENGTH, SLIDE, DELAY, compact_every=2)
    for number, rows in enumerate(batches):
        frame(spark, rows).coalesce(1).write.json(f"{tmp_path}/in/{number}")
        stream = readers.stream_json(spark, f"{tmp_path}/in/*", "ts timestamp, city string")
        query = found.writer(stream, f"{tmp_path}/cp", None).start()
        query.awaitTermination(120)
        assert query.exception() is None
    closed, late, _, _ = simulated(batches)
    assert {second(r.time): r.ground_truth for r in found.closed(spark).collect()} == closed
    assert {(second(r.time), r.value) for r in found.late(spark).collect()} == late
    columns = ["time", "ground_truth", "estimation"]
    assert sorted(map(tuple, found.rows(spark, "fixed").select(*columns).collect())) == batch_rows(spark, batches, columns)


def test_windows_by_arrival(spark, tmp_path):
    found = ClosingWindows(str(tmp_path), None, "city", 20, 10, 0)
    found.fold(frame(spark, [(1, "a"), (2, "b")]), 0)
    assert {r.ground_truth for r in found.rows(spark).collect()} == {2}
