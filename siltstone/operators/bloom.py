"""Approximate membership with a Bloom filter kept as 64-bit words.

A filter is a table ``(word bigint, bits bigint)`` with one row per 64 buckets, so its size is
fixed by the number of buckets and not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import (
    BLOOM_BUCKETS,
    BLOOM_HASHES,
    BLOOM_P,
    bloom_positions_of,
    text_mod,
)
from ..functions.text import present

WORD_BITS = 64
# Keys over which rows without a value are spread.
_MISSING = 4096
# Up to so many words (16 MB) a filter is broadcast, whatever it meets.
BROADCAST_WORDS = 1 << 20


def word_count(buckets: int) -> int:
    return -(-buckets // WORD_BITS)


def _with_positions(df: DataFrame, col: str, buckets: int, hashes: int) -> DataFrame:
    """Add ``_at``, the bit positions; the remainder stays a column so that it is folded once."""
    hashed = df.withColumn("_x", text_mod(col, BLOOM_P))
    positions = ", ".join(bloom_positions_of("_x", buckets, hashes))
    return hashed.withColumn("_at", F.expr(f"array({positions})")).drop("_x")


def bloom_build(
    df: DataFrame, col: str, buckets: int = BLOOM_BUCKETS, hashes: int = BLOOM_HASHES
) -> DataFrame:
    """Filter over the values of ``col``; null and empty values are not added.

    Values are made distinct first, with a map-side combine, and each is hashed once. Each task
    folds its positions into at most ``word_count(buckets)`` words before the second shuffle.
    """
    values = df.filter(present(F.col(col))).select(F.col(col).alias("value")).distinct()
    positions = (
        _with_positions(values, "value", buckets, hashes)
        .select(F.explode("_at").alias("position"))
        .selectExpr(
            f"position div {WORD_BITS} AS word",
            f"shiftleft(1L, cast(position % {WORD_BITS} as int)) AS bits",
        )
    )
    blank = df.sparkSession.range(word_count(buckets)).select(
        F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits")
    )
    return positions.unionByName(blank).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def bloom_positions(bloom: DataFrame) -> DataFrame:
    """The set bit positions as rows."""
    offsets = F.filter(
        F.sequence(F.lit(0), F.lit(WORD_BITS - 1)),
        lambda i: F.bit_get(F.col("bits"), i) == 1,
    )
    return bloom.select("word", F.explode(offsets).alias("offset")).select(
        (F.col("word") * WORD_BITS + F.col("offset")).alias("position")
    )


def bloom_probe(
    df: DataFrame,
    col: str,
    bloom: DataFrame,
    buckets: int = BLOOM_BUCKETS,
    hashes: int = BLOOM_HASHES,
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """Add ``prediction``: 1 if all positions of the value are set, else 0.

    Null and empty values get 0. A filter of up to ``broadcast_words`` words is broadcast: each position
    looks up its word, no row is copied, moved or aggregated, so a stream needs no state. In batch, a
    larger filter is met once by the positions of the distinct values, and rows find the value's answer
    in one more join. A stream meets a larger filter in one join for each hash. Write the filter to a
    table before it meets a stream.
    """
    small = word_count(buckets) <= broadcast_words
    if small or df.isStreaming:
        return _looked_up(df, col, F.broadcast(bloom) if small else bloom, buckets, hashes)
    values = df.filter(present(F.col(col))).select(F.col(col).alias("_value")).distinct()
    at = _with_positions(values, "_value", buckets, hashes).select("_value", F.explode("_at").alias("_position"))
    word = F.expr(f"_position div {WORD_BITS}") == F.col("word")
    bit = F.bit_get("bits", F.expr(f"cast(_position % {WORD_BITS} as int)"))
    found = at.join(bloom, word).groupBy("_value").agg(F.sum(bit.cast("int")).alias("_set")).where(F.col("_set") == hashes)
    # Rows without a value find nothing, spread over keys that no value has.
    salt = F.when(present(F.col(col)), 0).otherwise(1 + F.pmod(F.xxhash64(*df.columns), F.lit(_MISSING)))
    own = df.withColumns({"_key": F.coalesce(F.col(col), F.lit("")), "_salt": salt.cast("int")})
    marked = own.join(found.withColumn("_none", F.lit(0)), (F.col("_key") == F.col("_value")) & (F.col("_salt") == F.col("_none")), "left")
    return marked.select(*df.columns, F.col("_set").isNotNull().cast("int").alias("prediction"))


def _looked_up(df: DataFrame, col: str, bloom: DataFrame, buckets: int, hashes: int) -> DataFrame:
    """One join for each hash."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(_MISSING)).cast("bigint")
    probed = df.withColumn("_x", text_mod(col, BLOOM_P))
    tests = []
    for i, at in enumerate(bloom_positions_of("_x", buckets, hashes)):
        # Rows without a value find nothing, spread over keys that no filter has.
        word = F.coalesce(F.expr(f"{at} div {WORD_BITS}"), -1 - salt)
        words = bloom.select(F.col("word").alias(f"_word{i}"), F.col("bits").alias(f"_bits{i}"))
        probed = probed.withColumn(f"_at{i}", word).join(words, F.col(f"_at{i}") == F.col(f"_word{i}"), "left")
        tests.append(f"bit_get(_bits{i}, cast({at} % {WORD_BITS} as int)) = 1")
    hit = F.expr(f"CASE WHEN {' AND '.join(tests)} THEN 1 ELSE 0 END")
    return probed.select(*df.columns, hit.alias("prediction"))
