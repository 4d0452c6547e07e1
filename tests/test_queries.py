"""Each registered query against its SQL; BFR also against a plain computation."""

import pandas as pd
import pytest

import __spark_entry__ as driver
from compare import spark_rows, sql_connection, sql_rows
from plain_bfr import bfr
from siltstone.plans import ALL, clustering

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return sql_connection(FOLDER)


def test_entry_has_rows(spark):
    rows = driver.entry(spark)
    assert rows.columns == ["word", "count"]
    assert rows.count() == 50


def test_every_query_of_the_library_has_sql():
    assert {name for name, query in ALL.items() if query.sql} == set(ALL)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_equals_sql(spark, connection, name):
    columns, rows = spark_rows(driver.queries()[name](spark, FOLDER))
    sql_columns, expected = sql_rows(connection, driver.oracle_sql()[name])
    assert columns == sql_columns
    assert len(rows) == len(expected)
    assert rows == expected


def test_bfr_equals_plain_computation(spark):
    table = pd.read_parquet(f"{FOLDER}/embeddings.parquet")
    points = {int(i): [float(x) for x in v] for i, v in zip(table.vec_id, table.embedding)}
    n, parts = len(points), clustering.BFR_CHUNKS
    chunks = [{i: v for i, v in points.items() if i * parts // n == c} for c in range(parts)]
    labels, rounds = bfr(chunks, clustering.BFR_K, clustering.BFR_ALPHA)
    got = driver.queries()["bfr_rounds"](spark, FOLDER).orderBy("round_id").collect()
    assert [tuple(r) for r in got] == rounds
    assert {r.id: r.cluster for r in driver.queries()["bfr_labels"](spark, FOLDER).collect()} == labels
    # The parameters reach all three sets.
    assert all(value > 0 for value in rounds[-1])
