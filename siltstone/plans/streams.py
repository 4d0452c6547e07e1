"""The streaming operators over a whole table, read as a stream until nothing is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.sampling import popular_tags, tagged
from ..session import new_folder
from ..streaming import closing, distinct, membership, reservoir, sampling
from . import membership as filters
from . import samples, windows
from .registry import Query, table

# Files in a micro-batch, so that a large table isn't one.
FILES_PER_BATCH = 1_000

def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream of its files.

    A stream takes no path of a single file, but a pattern; this one matches the one name only.
    """
    schema = table(spark, folder, name).schema
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .parquet(f"{folder}/{name}.parque[t]")
    )


def finish(writer: DataStreamWriter) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def _written_rows(rows: DataFrame, label: str) -> DataFrame:
    """Append the rows of a stream to a table in the shared folder and read the table."""
    folder = new_folder(rows.sparkSession, label)
    finish(
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .option("path", f"{folder}/rows")
    )
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{folder}/rows")


def _windows(spark: SparkSession, folder: str, exact: bool) -> DataFrame:
    state = new_folder(spark, "stream-windows")
    events = source(spark, folder, "events")
    writer = distinct.stream_windows(
        events, "ts", "user_id", windows.LENGTH, windows.SLIDE, state, f"{state}/checkpoint", exact
    )
    finish(writer)
    return distinct.window_rows(spark, state, windows.LENGTH, windows.SLIDE, exact)


def stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    return _windows(spark, folder, True)


def stream_estimates(spark: SparkSession, folder: str) -> DataFrame:
    return _windows(spark, folder, False)


def stream_predictions(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "stream-filter")
    membership.save_bloom(filters.users(spark, folder), "user", path)
    customers = source(spark, folder, "customer").select(
        "c_custkey", F.col("c_custkey").cast("string").alias("user")
    )
    found = membership.stream_predictions(customers, "user", path)
    return _written_rows(found.select("c_custkey", "prediction"), "stream-predictions")


def stream_predictions_large(spark: SparkSession, folder: str) -> DataFrame:
    """The stream against a filter of 1.25 MB."""
    path, size = new_folder(spark, "stream-filter"), (filters.LARGE_BUCKETS, filters.LARGE_HASHES)
    membership.save_bloom(filters.users(spark, folder), "user", path, *size)
    customers = source(spark, folder, "customer").select(
        "c_custkey", F.col("c_custkey").cast("string").alias("user")
    )
    found = membership.stream_predictions(customers, "user", path, *size)
    return _written_rows(found.select("c_custkey", "prediction"), "stream-predictions")


def _sample(spark: SparkSession, folder: str) -> DataFrame:
    events = tagged(samples.with_tags(source(spark, folder, "events")), "tags")
    state = new_folder(spark, "stream-sample")
    finish(
        sampling.stream_reservoir(events, "event_id", "tags", state, samples.SIZE, samples.SEED)
    )
    return sampling.last_sample(spark, state)


def _state_sample(spark: SparkSession, folder: str) -> str:
    """The sample kept in the state store, over all events."""
    state = new_folder(spark, "state-sample")
    events = samples.with_tags(source(spark, folder, "events"))
    query = reservoir.start_reservoir(events, "event_id", "tags", state, samples.SIZE, samples.SEED, interval=None)
    query.awaitTermination()
    return state


def stream_state_sample(spark: SparkSession, folder: str) -> DataFrame:
    return reservoir.sample_now(spark, _state_sample(spark, folder), "event_id bigint")


def stream_state_tags(spark: SparkSession, folder: str) -> DataFrame:
    """The last report: records seen and popular tags."""
    found = reservoir.reports(spark, _state_sample(spark, folder))
    last = found.agg(F.max("batch")).first()[0]
    return found.where(F.col("batch") == last).select("seen", "tag", "count")


def stream_sample(spark: SparkSession, folder: str) -> DataFrame:
    return _sample(spark, folder).select("event_id")


def stream_popular_tags(spark: SparkSession, folder: str) -> DataFrame:
    return popular_tags(_sample(spark, folder), "tags")


# Seconds that a window waits for values after its end.
DELAY = 24 * 3600


def _two_deliveries(spark: SparkSession, folder: str) -> closing.ClosingWindows:
    """Purchases are delivered after all other events, so theirs come late."""
    events = table(spark, folder, "events")
    path = new_folder(spark, "closing-windows")
    found = closing.ClosingWindows(f"{path}/state", "ts", "user_id", windows.LENGTH, windows.SLIDE, DELAY)
    late = F.col("event_type").eqNullSafe("purchase")
    for name, part in (("first", events.where(~late)), ("second", events.where(late))):
        part.write.parquet(f"{path}/in/{name}")
        stream = spark.readStream.schema(events.schema).parquet(f"{path}/in/*")
        finish(found.writer(stream, f"{path}/checkpoint"))
    return found


def closing_windows(spark: SparkSession, folder: str) -> DataFrame:
    """All windows after both deliveries, those that had closed corrected."""
    return _two_deliveries(spark, folder).rows(spark)


def closing_windows_late(spark: SparkSession, folder: str) -> DataFrame:
    """Values of the second delivery for windows that had closed."""
    return _two_deliveries(spark, folder).late(spark)


def closing_windows_first(spark: SparkSession, folder: str) -> DataFrame:
    """Windows as they closed, before the second delivery corrects them."""
    return _two_deliveries(spark, folder).closed(spark).select("time", "ground_truth")


_CLOSED_BY = f"(SELECT max(ts) - INTERVAL '{DELAY} seconds' FROM events WHERE event_type IS DISTINCT FROM 'purchase')"
_FIRST_CLOSED = f"""
  SELECT time, count(*) AS ground_truth
  FROM ({windows.pairs_sql("event_type IS DISTINCT FROM 'purchase'")})
  WHERE CAST(time AS TIMESTAMP) <= {_CLOSED_BY} GROUP BY time
"""
# A window of which the first delivery had nothing opens with the second, and closes with it.
_THEN_CLOSED = f"""
  SELECT time, count(*) AS ground_truth FROM ({windows.pairs_sql("true")})
  WHERE CAST(time AS TIMESTAMP) > {_CLOSED_BY}
    AND CAST(time AS TIMESTAMP) <= (SELECT max(ts) - INTERVAL '{DELAY} seconds' FROM events)
  GROUP BY time
"""

QUERIES = {
    "stream_state_sample": Query(
        stream_state_sample, f"SELECT event_id FROM ({samples.QUERIES['reservoir_sample'].sql})"
    ),
    "stream_state_tags": Query(
        stream_state_tags,
        f"SELECT (SELECT count(*) FROM events) AS seen, tag, count FROM ({samples.QUERIES['popular_tags'].sql})",
    ),
    "closing_windows": Query(closing_windows, windows.QUERIES["fm_window_kmeans"].sql),
    "closing_windows_late": Query(
        closing_windows_late,
        f"""
        SELECT time, u AS value FROM ({windows.pairs_sql("event_type = 'purchase'")})
        WHERE CAST(time AS TIMESTAMP) <= {_CLOSED_BY}
        GROUP BY time, u
        """,
    ),
    "closing_windows_first": Query(closing_windows_first, f"{_FIRST_CLOSED} UNION ALL {_THEN_CLOSED}"),
    "stream_windows": Query(stream_windows, windows.QUERIES["fm_window_kmeans"].sql),
    "stream_estimates": Query(stream_estimates, windows.QUERIES["fm_window_estimate"].sql),
    "stream_predictions": Query(stream_predictions, filters.QUERIES["bloom_probe"].sql),
    "stream_predictions_large": Query(
        stream_predictions_large, filters.QUERIES["bloom_probe_large"].sql
    ),
    "stream_sample": Query(
        stream_sample, f"SELECT event_id FROM ({samples.QUERIES['reservoir_sample'].sql})"
    ),
    "stream_popular_tags": Query(stream_popular_tags, samples.QUERIES["popular_tags"].sql),
}
