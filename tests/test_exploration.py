import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators import exploration as ops
from siltstone.operators import partitions
from siltstone import session

REVIEWS = [
    ("r1", "u1", "b1", "2018-01-01", 5.0, "The, the cat"),
    ("r2", "u1", "b1", "2017-05-01", 3.0, "cat  cat ?!"),
    ("r2", "u2", "b2", "2018-03-01", 1.0, "a\nb dog"),
    ("r4", "u3", "b3", "2019-03-01", 4.0, None),
    ("r5", "u2", "b1", "2018-03-09", 2.0, ""),
]
BUSINESS = [
    ("b1", "A, B"), ("b2", "A, A"), ("b3", None), ("b4", "C"), ("b5", ""), ("b1", "B"), ("b1", "B"),
]


@pytest.fixture()
def reviews(spark):
    schema = "review_id string, user_id string, business_id string, date string, stars double, text string"
    return spark.createDataFrame(REVIEWS, schema)


@pytest.fixture()
def business(spark):
    return spark.createDataFrame(BUSINESS, "business_id string, categories string")


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_review_summary(reviews):
    got = ops.review_summary(reviews, "review_id", "user_id", "date", 2018)
    assert rows(got) == [(5, 4, 3, 3)]


def test_top_users_break_ties_by_key(reviews):
    assert rows(ops.top_users(reviews, "user_id", 2)) == [("u1", 2), ("u2", 2)]


EXPECTED_WORDS = {"the": 1, "cat": 3, "a\nb": 1, "dog": 1}


def test_stop_words_are_compared_before_punctuation_goes(reviews):
    assert dict(rows(ops.word_counts(reviews, "text", ["the"]))) == EXPECTED_WORDS
    assert rows(ops.top_words(reviews, "text", ["the"], 2)) == [("cat", 3), ("a\nb", 1)]


def test_stop_word_lists_and_tables(spark, reviews):
    table = spark.createDataFrame([("the",), ("other",), (None,), ("the",)], "word string")
    assert dict(rows(ops.word_counts(reviews, "text", table))) == EXPECTED_WORDS
    assert dict(rows(ops.word_counts(reviews, "text", ["the", None, "other", "the"]))) == EXPECTED_WORDS
    assert dict(rows(ops.word_counts(reviews, "text", [])))["the"] == 2


def test_categories(reviews, business):
    # b1: 10 stars in 3 reviews, listed under A once and under B three times.
    totals = ops.category_totals(reviews, business, "business_id", "stars", "categories")
    assert {r[0]: r[1:] for r in rows(totals)} == {"A": (12.0, 5), "B": (30.0, 9)}
    best = ops.category_avg(reviews, business, "business_id", "stars", "categories", 1)
    assert rows(best) == [("B", pytest.approx(10 / 3))]


def test_frequent_keys(reviews):
    assert rows(ops.frequent_keys(reviews, "business_id", 1)) == [("b1", 3)]
    assert rows(ops.frequent_keys(reviews, "business_id", 3)) == []


def test_review_report(reviews):
    words = ops.top_words(reviews, "text", ["the"], 2)
    got = ops.review_report(reviews, "review_id", "user_id", "date", 2018, 2, words)
    assert json.loads(got.first().document) == {
        "A": 4, "B": 3, "C": 3,
        "D": [{"user_id": "u1", "count": 2}, {"user_id": "u2", "count": 2}],
        "E": ["cat", "a\nb"],
    }


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert rows(session.written(spark.range(3), "t").orderBy("id")) == [(0,), (1,), (2,)]


KEYS = ["apple", "avocado", "banana", "éclair", "cherry", "apple", "", None]


def plain_census(fn, n):
    import binascii

    code = {
        "crc": lambda k: binascii.crc32(k[:1].encode()),
        "ascii": lambda k: ord(k[0]) if k else 0,
    }[fn]
    counts = Counter(code(k) % n if k is not None else 0 for k in KEYS)
    return [(i, counts.get(i, 0)) for i in range(n)]


@pytest.mark.parametrize("fn", ["crc", "ascii"])
@pytest.mark.parametrize("n", [1, 3, 20])
def test_census(spark, fn, n):
    frame = spark.createDataFrame([(k,) for k in KEYS], "k string")
    census = partitions.partition_census(frame, "k", n, fn)
    assert sorted(rows(census)) == plain_census(fn, n)
    moved = partitions.repartition_by_key(frame, "k", n, fn)
    assert partitions.partition_count(moved) == n
    assert sorted(rows(partitions.physical_census(moved))) == plain_census(fn, n)


def test_census_with_own_function(spark):
    frame = spark.createDataFrame([(k,) for k in KEYS if k], "k string")
    census = partitions.partition_census(frame, "k", 10, F.length)
    assert dict(rows(census))[6] == 3  # banana, éclair, cherry


def test_default_partitioning_is_kept(spark):
    frame = spark.range(100, numPartitions=5)
    assert partitions.repartition_by_key(frame, "id", 3, None) is frame
    assert rows(partitions.physical_census(frame).orderBy("partition")) == [
        (i, 20) for i in range(5)
    ]


def test_hot_partition_is_split(spark):
    frame = spark.range(4000).select("id", F.lit("same").alias("k"))
    moved = partitions.repartition_by_key(frame, "k", 3, "ascii", splits=4)
    sizes = [n for _, n in rows(partitions.physical_census(moved)) if n]
    assert len(sizes) == 4 and sum(sizes) == 4000 and max(sizes) < 1500


def test_census_document(spark):
    frame = spark.createDataFrame([(k,) for k in KEYS if k], "k string")
    census = partitions.partition_census(frame, "k", 2, "ascii")
    document = partitions.census_document(census).first()[0]
    assert json.loads(document) == {"n_partitions": 2, "n_items": [1, 5]}
