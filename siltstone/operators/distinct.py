"""Exact and estimated distinct counts in sliding windows, in batch.

Rows are first reduced to panes, the slices between window borders. Only the reduced panes are
spread over the windows that cover them.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.estimators import middle_of_fixed_groups, middle_of_kmeans_groups
from ..functions.hashing import FM_A, FM_P, fm_trailing_zeros, text_mod
from ..functions.text import present

ZERO_COLUMNS = [f"z{i}" for i in range(len(FM_A))]
COMBINE = {"fixed": middle_of_fixed_groups, "kmeans": middle_of_kmeans_groups}


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def epoch_seconds(df: DataFrame, ts: str) -> Column:
    """Whole seconds since 1970 in UTC. A time without zone counts as UTC, whatever the session's."""
    if dict(df.dtypes)[ts] == "timestamp":
        return F.unix_seconds(F.col(ts))
    since = f"(cast(`{ts}` as timestamp_ntz) - {_EPOCH})"
    parts = f"extract(DAY FROM {since}) * 86400 + extract(HOUR FROM {since}) * 3600 + extract(MINUTE FROM {since}) * 60"
    return F.expr(f"cast({parts} + floor(extract(SECOND FROM {since})) as bigint)")


def window_label(end: Column) -> Column:
    """Text of a second since 1970, in UTC."""
    return (F.expr(_EPOCH) + F.make_dt_interval(secs=end.cast("decimal(18, 6)"))).cast("string")


def timed_panes(df: DataFrame, ts: str, value: str, length: int, slide: int) -> DataFrame:
    """``pane`` (its first second), ``second`` and ``value`` of every row with a time and a value."""
    width = gcd(length, slide)
    text = F.col(value).cast("string")
    rows = df.filter(present(text) & F.col(ts).isNotNull()).select(
        epoch_seconds(df, ts).alias("second"), text.alias("value")
    )
    return rows.select((F.col("second") - F.pmod("second", F.lit(width))).alias("pane"), "second", "value")


def panes(df: DataFrame, ts: str, value: str, length: int, slide: int) -> DataFrame:
    """``pane`` and ``value`` of every row with a time and a value."""
    return timed_panes(df, ts, value, length, slide).select("pane", "value")


def pane_values(df: DataFrame, ts: str, value: str, length: int, slide: int) -> DataFrame:
    """Distinct ``(pane, value)``."""
    return panes(df, ts, value, length, slide).distinct()


def pane_bits(df: DataFrame, ts: str, value: str, length: int, slide: int) -> DataFrame:
    """Longest runs ``z0`` to ``z11`` per pane: 12 maxima, no value is shuffled."""
    hashed = panes(df, ts, value, length, slide).withColumn("x", text_mod("value", FM_P))
    return hashed.groupBy("pane").agg(*zero_runs("x"))


def window_ends(length: int, slide: int) -> Column:
    """Ends of the windows that cover a pane; windows start at multiples of ``slide``."""
    last = F.col("pane") - F.pmod(F.col("pane"), F.lit(slide))
    starts = F.transform(F.sequence(F.lit(0), F.lit((length - 1) // slide)), lambda k: last - k * slide)
    covering = F.filter(starts, lambda start: start + length > F.col("pane"))
    return F.explode(F.transform(covering, lambda start: start + length)).alias("end")


def window_times(panes: DataFrame, length: int, slide: int) -> DataFrame:
    """Labels of the windows that cover some of the panes."""
    return panes.select(window_ends(length, slide)).distinct().select(window_label(F.col("end")).alias("time"))


def values_by_window(pairs: DataFrame, length: int, slide: int) -> DataFrame:
    """Distinct ``(end, value)`` from ``(pane, value)``."""
    return pairs.select(window_ends(length, slide), "value").distinct()


def counts_by_end(pairs: DataFrame, length: int, slide: int) -> DataFrame:
    """``end``, ``ground_truth`` and the runs from ``(pane, value)``."""
    hashed = values_by_window(pairs, length, slide).withColumn("x", text_mod("value", FM_P))
    return hashed.groupBy("end").agg(F.count(F.lit(1)).alias("ground_truth"), *zero_runs("x"))


def counts_by_window(pairs: DataFrame, length: int, slide: int) -> DataFrame:
    """``time``, ``ground_truth`` and the runs from distinct ``(pane, value)``."""
    counted = counts_by_end(pairs, length, slide)
    return counted.select(window_label(F.col("end")).alias("time"), "ground_truth", *ZERO_COLUMNS)


def bits_by_end(bits: DataFrame, length: int, slide: int) -> DataFrame:
    """``end`` and the runs from runs per pane."""
    spread = bits.select(window_ends(length, slide), *ZERO_COLUMNS)
    return spread.groupBy("end").agg(*[F.max(z).alias(z) for z in ZERO_COLUMNS])


def bits_by_window(bits: DataFrame, length: int, slide: int) -> DataFrame:
    """``time`` and the runs from runs per pane."""
    return bits_by_end(bits, length, slide).select(window_label(F.col("end")).alias("time"), *ZERO_COLUMNS)


def window_distinct(df: DataFrame, ts: str, value: str, length: int, slide: int) -> DataFrame:
    """Exact distinct count per window: ``time`` (window end, UTC) and ``ground_truth``."""
    pairs = values_by_window(pane_values(df, ts, value, length, slide), length, slide)
    counted = pairs.groupBy("end").agg(F.count(F.lit(1)).alias("ground_truth"))
    return counted.select(window_label(F.col("end")).alias("time"), "ground_truth")


def zero_runs(value: str) -> list[Column]:
    """Aggregates: longest run of trailing zeros under each hash function."""
    zeros = fm_trailing_zeros(value)
    return [F.max(z).alias(name) for z, name in zip(zeros, ZERO_COLUMNS)]


def fm_window_bits(df: DataFrame, ts: str, value: str, length: int, slide: int) -> DataFrame:
    """Longest runs ``z0`` to ``z11`` per window. No value is shuffled, only 12 maxima."""
    return bits_by_window(pane_bits(df, ts, value, length, slide), length, slide)


def with_estimate(df: DataFrame, combine: str = "kmeans") -> DataFrame:
    """Replace ``z0`` to ``z11`` by ``estimation``."""
    if combine not in COMBINE:
        raise ValueError("combine must be 'fixed' or 'kmeans'")
    estimates = F.expr("array(" + ", ".join(f"power(2D, {z})" for z in ZERO_COLUMNS) + ")")
    return (
        df.withColumn("_estimates", estimates)
        .withColumn("estimation", COMBINE[combine]("_estimates"))
        .drop("_estimates", *ZERO_COLUMNS)
    )


def fm_estimates(
    df: DataFrame, ts: str, value: str, length: int, slide: int, combine: str = "kmeans"
) -> DataFrame:
    """Estimate per window, without the exact count."""
    return with_estimate(fm_window_bits(df, ts, value, length, slide), combine)


def fm_windows(
    df: DataFrame, ts: str, value: str, length: int, slide: int, combine: str = "kmeans"
) -> DataFrame:
    """``time``, ``ground_truth`` and ``estimation`` per window.

    Rows without a time or a value count nowhere. The exact count needs the distinct pairs anyway,
    so only those are hashed.
    """
    pairs = pane_values(df, ts, value, length, slide)
    return with_estimate(counts_by_window(pairs, length, slide), combine)
