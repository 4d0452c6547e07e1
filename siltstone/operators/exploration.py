"""Summary questions over review-like records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import comma_list, in_year, present, strip_punctuation, tokens


def review_summary(df: DataFrame, review: str, user: str, date: str, year: int) -> DataFrame:
    """One row from one scan: rows, distinct reviews, rows of ``year``, distinct users."""
    of_year = in_year(F.col(date), dict(df.dtypes)[date], year)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(review).alias("n_reviews"),
        F.count_if(of_year).alias("n_in_year"),
        F.count_distinct(user).alias("n_users"),
    )


def review_summary_bitmaps(df: DataFrame, review: str, user: str, date: str, year: int) -> DataFrame:
    """:func:`review_summary` for integer reviews and users: distinct ones are bits.

    A task sends a bitmap of 4 KB for each 32,768 neighbouring numbers of which it has seen any, so the
    shuffle doesn't grow with the rows, and rows aren't expanded by a plan of several distinct counts.
    It pays where numbers are dense.
    """
    of_year = in_year(F.col(date), dict(df.dtypes)[date], year)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("of"), F.col(c).cast("bigint").alias("number")) for i, c in enumerate((review, user))]))
    numbers = df.select(of_year.alias("in_year"), each.alias("each")).select("in_year", "each.*")
    bits = numbers.groupBy("of", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"),
        F.count(F.lit(1)).alias("n"),
        F.count_if("in_year").alias("n_in_year"),
    )

    def total(of: int, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("of") == of, value)), F.lit(0))

    return bits.agg(
        total(0, F.col("n")).alias("n_rows"),
        total(0, F.bitmap_count("bits")).alias("n_reviews"),
        total(0, F.col("n_in_year")).alias("n_in_year"),
        total(1, F.bitmap_count("bits")).alias("n_users"),
    )


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def top_users(df: DataFrame, user: str, m: int) -> DataFrame:
    """The ``m`` most frequent users; ties by user."""
    return key_counts(df, user).orderBy(F.desc("count"), F.asc(user)).limit(m)


def frequent_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """Keys with more than ``n`` rows."""
    return key_counts(df, key).filter(F.col("count") > n)


def stop_tokens(df: DataFrame, stop_words: Sequence[str | None] | DataFrame) -> DataFrame:
    """Stop words as ``token``; null stop words stand for nothing."""
    if not isinstance(stop_words, DataFrame):
        stop_words = df.sparkSession.createDataFrame([(word,) for word in stop_words], "word string")
    return stop_words.select(F.col(stop_words.columns[0]).alias("token")).filter(F.col("token").isNotNull())


def words(df: DataFrame, text: str, stop_words: Sequence[str | None] | DataFrame) -> DataFrame:
    """One row per word that is no stop word, as :func:`word_counts` counts them."""
    each = df.select(F.explode(tokens(F.col(text))).alias("token")).join(stop_tokens(df, stop_words), "token", "left_anti")
    return each.select(strip_punctuation(F.col("token")).alias("word")).filter(F.col("word") != "")


def word_counts(df: DataFrame, text: str, stop_words: Sequence[str | None] | DataFrame) -> DataFrame:
    """Rows per word. A stop word is compared before punctuation is removed.

    Tokens are counted first, so a hot word meets the stop words as one row, whatever their number.
    Null stop words stand for nothing.
    """
    given = df.select(F.explode(tokens(F.col(text))).alias("token")).filter(F.col("token") != "")
    return (
        key_counts(given, "token")
        .join(stop_tokens(df, stop_words), "token", "left_anti")
        .select(strip_punctuation(F.col("token")).alias("word"), "count")
        .filter(F.col("word") != "")
        .groupBy("word")
        .agg(F.sum("count").alias("count"))
    )


def top_words(
    df: DataFrame, text: str, stop_words: Sequence[str] | DataFrame, n: int
) -> DataFrame:
    """The ``n`` most frequent words; ties by word."""
    counts = word_counts(df, text, stop_words)
    return counts.orderBy(F.desc("count"), F.asc("word")).limit(n)


def category_totals(
    reviews: DataFrame, business: DataFrame, key: str, stars: str, categories: str
) -> DataFrame:
    """Sum and number of stars per category.

    Stars are summed per business before the join, and equal business rows are counted before
    it, so a hot business meets the join as one row on each side.
    """
    scores = (
        reviews.select(key, F.col(stars).cast("double").alias("stars"))
        .filter(F.col("stars").isNotNull())
        .groupBy(key)
        .agg(F.sum("stars").alias("score"), F.count("stars").alias("votes"))
    )
    listed = (
        business.filter(present(F.col(categories)))
        .groupBy(key, F.col(categories).alias("categories"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return (
        listed.join(scores, key, "inner")
        .select(
            F.explode(comma_list(F.col("categories"))).alias("category"),
            (F.col("score") * F.col("copies")).alias("score"),
            (F.col("votes") * F.col("copies")).alias("votes"),
        )
        .groupBy("category")
        .agg(F.sum("score").alias("star_sum"), F.sum("votes").alias("star_count"))
    )


def category_avg(
    reviews: DataFrame, business: DataFrame, key: str, stars: str, categories: str, n: int
) -> DataFrame:
    """The ``n`` categories with the highest average stars per review; ties by name."""
    return (
        category_totals(reviews, business, key, stars, categories)
        .select("category", (F.col("star_sum") / F.col("star_count")).alias("avg"))
        .orderBy(F.desc("avg"), F.asc("category"))
        .limit(n)
    )


def review_report(
    df: DataFrame,
    review: str,
    user: str,
    date: str,
    year: int,
    m: int,
    words: DataFrame,
) -> DataFrame:
    """One JSON document with the answers A to E.

    ``words`` is a result of :func:`top_words`. Only the one-row summary and the two limited
    lists are gathered.
    """
    summary = review_summary(df, review, user, date, year)
    user_list = top_users(df, user, m).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("rank"), F.col(user)))),
            lambda e: F.struct(e[user].alias("user_id"), (-e["rank"]).alias("count")),
        )
    )
    word_list = words.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("rank"), "word"))),
            lambda e: e["word"],
        )
    )
    answers = F.struct(
        F.col("n_reviews").alias("A"),
        F.col("n_in_year").alias("B"),
        F.col("n_users").alias("C"),
        user_list.scalar().alias("D"),
        word_list.scalar().alias("E"),
    )
    return summary.select(F.to_json(answers).alias("document"))
