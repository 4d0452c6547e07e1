"""Uniform samples of fixed size and popular tags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_text(columns: Sequence[str]) -> Column:
    """A row as JSON, times to the microsecond."""
    times = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.to_json(F.struct(*[F.col(f"`{name}`") for name in columns]), times)


def priority(row_id: Column, seed: int, columns: Sequence[str]) -> Column:
    """Reproducible random order: hash of the seed and the id, or of the whole row where the id is null."""
    own = F.coalesce(F.concat(F.lit(f"{seed}:"), row_id.cast("string")), F.concat(F.lit(f"{seed}:row:"), row_text(columns)))
    return F.md5(own.cast("binary"))


def in_draw_order(df: DataFrame, row_id: str, seed: int = 666, columns: Sequence[str] | None = None) -> list[Column]:
    """Sort keys that put rows into random order: their hash, then the row itself.

    ``columns`` are those that make up a row, by default all. Rows that share an id, and equal rows
    without an id, are one draw: they follow each other.
    """
    columns = columns or df.columns
    return [priority(F.col(row_id), seed, columns), row_text(columns)]


def reservoir(df: DataFrame, row_id: str, k: int, seed: int = 666, columns: Sequence[str] | None = None) -> DataFrame:
    """Uniform sample of ``k`` rows, or all rows if there are fewer.

    The k smallest priorities of a union are the k smallest of the parts' k smallest, so each
    task keeps k rows only and samples of parts can be merged exactly. Rows without an id are drawn
    like the others; see :func:`in_draw_order` for them and for repeated ids.
    """
    return df.orderBy(*in_draw_order(df, row_id, seed, columns)).limit(k)


def tagged(df: DataFrame, tags: str) -> DataFrame:
    """Records with at least one tag."""
    return df.filter(F.size(F.col(tags)) > 0)


def tag_texts(hashtags: Column) -> Column:
    """Texts of a list of tag structs."""
    return F.transform(hashtags, lambda tag: tag["text"])


def tag_counts(sample: DataFrame, tags: str) -> DataFrame:
    return (
        sample.select(F.explode(F.col(tags)).alias("tag"))
        .groupBy("tag")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def popular_tags(sample: DataFrame, tags: str, top: int = 3) -> DataFrame:
    """Tags whose count is among the ``top`` largest distinct counts, ties kept.

    The smallest of these counts is looked up first, so that no task ranks all tags.
    """
    counts = tag_counts(sample, tags)
    largest = counts.select("count").distinct().orderBy(F.desc("count")).limit(top)
    least = largest.agg(F.min("count")).scalar()
    return counts.filter(F.col("count") >= least).orderBy(F.desc("count"), F.asc("tag"))


def topic_filter(
    df: DataFrame, text: str, topics: Sequence[str], lang: str, languages: Sequence[str] = ("en",)
) -> DataFrame:
    """Records in one of ``languages`` whose text contains a topic, without regard to case.

    The text is bound to a lambda variable, so that it is lowered once for all topics.
    """

    def any_topic(lowered: Column) -> Column:
        return reduce(lambda a, b: a | b, [lowered.contains(t.lower()) for t in topics])

    found = F.exists(F.array(F.lower(F.col(text))), any_topic)
    return df.filter(F.col(lang).isin(list(languages)) & found)
