"""Distinct users per sliding window: exact, and the two estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import distinct as ops
from .membership import mod_sql
from .registry import Query, table

# Fixed values of the hash functions and of the one-dimensional k-means. The SQL below is written with
# them; the package has its own copy.
FM_P, ZERO_HASH_DIGITS = 233333333, 20
FM_A = (
    92293349, 106073835, 23011172, 213736157, 30805497, 212504684,
    11264739, 184667389, 19324851, 119400483, 7477916, 141366358,
)
FM_B = (
    110622591, 204219772, 36495850, 105613687, 37311918, 183739243,
    196215011, 181999220, 114959837, 91463773, 155009252, 220187013,
)
START_POSITIONS, MAX_ROUNDS, COMPARED_DECIMALS = (7, 6, 10), 5, 1
LENGTH = 30 * 3600
SLIDE = 10 * 3600
_ARGS = ("ts", "user_id", LENGTH, SLIDE)


def window_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return ops.window_distinct(table(spark, folder, "events"), *_ARGS)


def fm_window_bits(spark: SparkSession, folder: str) -> DataFrame:
    return ops.fm_window_bits(table(spark, folder, "events"), *_ARGS)


def fm_window_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return ops.fm_windows(table(spark, folder, "events"), *_ARGS, "fixed")


def fm_window_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    return ops.fm_windows(table(spark, folder, "events"), *_ARGS, "kmeans")


def fm_window_estimate(spark: SparkSession, folder: str) -> DataFrame:
    return ops.fm_estimates(table(spark, folder, "events"), *_ARGS, "kmeans")


_LAST_SLICE = f"time_bucket(INTERVAL '{SLIDE} seconds', ts, TIMESTAMP '1970-01-01')"
def pairs_sql(chosen: str) -> str:
    """Distinct (time, user) of the chosen events; a user is named once for each slice with the user."""
    return f"""
      SELECT DISTINCT strftime(window_start + INTERVAL '{LENGTH} seconds', '%Y-%m-%d %H:%M:%S') AS time, u
      FROM (
        SELECT DISTINCT CAST(user_id AS VARCHAR) AS u,
               unnest(generate_series({_LAST_SLICE} - INTERVAL '{LENGTH - SLIDE} seconds',
                                      {_LAST_SLICE}, INTERVAL '{SLIDE} seconds')) AS window_start
        FROM events WHERE {chosen}
      )
    """


_PAIRS_SQL = pairs_sql("true")


def zeros_sql(a: int, b: int) -> str:
    value = f"((x * {a}::BIGINT + {b}) % {FM_P})"
    return (
        f"CASE WHEN {value} = 0 THEN {ZERO_HASH_DIGITS} "
        f"ELSE CAST(bit_count(({value} & -{value}) - 1) AS INTEGER) END"
    )


_RUNS = ", ".join(
    f"max({zeros_sql(a, b)}) AS z{i}" for i, (a, b) in enumerate(zip(FM_A, FM_B))
)
_HASHED_SQL = f"SELECT u, {mod_sql('u', FM_P)} AS x FROM (SELECT DISTINCT u FROM pairs)"
_BITS_SQL = f"""
  WITH pairs AS ({_PAIRS_SQL}), hashed AS ({_HASHED_SQL})
  SELECT time, count(*) AS ground_truth, {_RUNS}
  FROM pairs JOIN hashed USING (u) GROUP BY time
"""
_ZEROS = [f"z{i}" for i in range(len(FM_A))]
_ESTIMATES = "[" + ", ".join(f"pow(2.0::DOUBLE, {z})" for z in _ZEROS) + "]"
_FIXED_SQL = f"""
  SELECT time, ground_truth, CAST(floor(list_sort(
           [list_avg(e[1:4]), list_avg(e[5:8]), list_avg(e[9:12])])[2]) AS BIGINT) AS estimation
  FROM (SELECT time, ground_truth, {_ESTIMATES} AS e FROM ({_BITS_SQL}))
"""


def _kmeans_sql() -> str:
    """Rounds of the one-dimensional k-means, one query level per round."""
    start = ", ".join(f"e[{p + 1}] AS c{g}" for g, p in enumerate(START_POSITIONS))
    level = f"""
      SELECT *, {start}, false AS f0, false AS f1, false AS f2,
             0.0::DOUBLE AS m0, 0.0::DOUBLE AS m1, 0.0::DOUBLE AS m2, false AS done
      FROM (SELECT time, ground_truth, {_ESTIMATES} AS e FROM ({_BITS_SQL}))
    """
    near = (
        "abs(c0 - v) <= abs(c1 - v) AND abs(c0 - v) <= abs(c2 - v)",
        "abs(c1 - v) < abs(c0 - v) AND abs(c1 - v) <= abs(c2 - v)",
        "abs(c2 - v) < abs(c0 - v) AND abs(c2 - v) < abs(c1 - v)",
    )
    for _ in range(MAX_ROUNDS):
        groups = ", ".join(
            f"list_filter(e, lambda v: {test}) AS g{g}" for g, test in enumerate(near)
        )
        moved = ", ".join(
            f"CASE WHEN f{g} THEN c{g} "
            f"ELSE (c{g} + coalesce(list_sum(g{g}), 0)) / (1 + len(g{g})) END AS n{g}"
            for g in range(3)
        )
        changed = ", ".join(
            f"round_even(n{g}, {COMPARED_DECIMALS}) <> round_even(c{g}, {COMPARED_DECIMALS}) AS h{g}"
            for g in range(3)
        )
        after = {
            **{f"c{g}": f"n{g}" for g in range(3)},
            "f0": "NOT h0",
            "f1": "CASE WHEN h0 THEN f1 ELSE NOT h1 END",
            "f2": "CASE WHEN h0 OR h1 THEN f2 ELSE NOT h2 END",
            **{f"m{g}": f"coalesce(list_avg(g{g}), 0)" for g in range(3)},
            "done": "NOT (h0 OR h1 OR h2)",
        }
        kept = ", ".join(
            f"CASE WHEN done THEN {name} ELSE {value} END AS {name}"
            for name, value in after.items()
        )
        level = f"""
          SELECT time, ground_truth, e, {kept}
          FROM (SELECT *, {changed} FROM (SELECT *, {moved} FROM (SELECT *, {groups}
                FROM ({level}))))
        """
    return f"""
      SELECT time, ground_truth,
             CAST(floor(list_sort([m0, m1, m2])[2]) AS BIGINT) AS estimation
      FROM ({level})
    """


QUERIES = {
    "window_distinct": Query(
        window_distinct,
        f"SELECT time, count(*) AS ground_truth FROM ({_PAIRS_SQL}) GROUP BY time",
    ),
    "fm_window_bits": Query(
        fm_window_bits, f"SELECT time, {', '.join(_ZEROS)} FROM ({_BITS_SQL})"
    ),
    "fm_window_fixed": Query(fm_window_fixed, _FIXED_SQL),
    "fm_window_kmeans": Query(fm_window_kmeans, _kmeans_sql()),
    "fm_window_estimate": Query(
        fm_window_estimate, f"SELECT time, estimation FROM ({_kmeans_sql()})"
    ),
}
