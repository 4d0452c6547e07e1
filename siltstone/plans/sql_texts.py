"""The package's functions in statements of ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.sql import register
from . import exploration, membership, windows
from .registry import Query, table


def _run(spark: SparkSession, folder: str, statement: str, *names: str) -> DataFrame:
    """A statement over tables by name; functions are defined and names are bound for it."""
    register(spark)
    return spark.sql(statement, **{name: table(spark, folder, name) for name in names})


_STOP = ", ".join(f"'{word}'" for word in exploration.STOP_WORDS)


def sql_top_words(spark: SparkSession, folder: str) -> DataFrame:
    return _run(
        spark,
        folder,
        f"""
        SELECT strip_punctuation(token) AS word, count(*) AS count
        FROM (SELECT explode(parts) AS token FROM (SELECT text_tokens(text) AS parts FROM {{documents}}))
        WHERE token NOT IN ({_STOP}) AND strip_punctuation(token) <> ''
        GROUP BY 1 ORDER BY count DESC, word LIMIT {exploration.TOP_WORDS}
        """,
        "documents",
    )


def sql_category_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of each category, from the items of a comma list."""
    return _run(
        spark,
        folder,
        """
        SELECT item AS category, count(*) AS n_parts
        FROM {part} AS p, LATERAL comma_items(concat(p.p_brand, ', ', p.p_type))
        GROUP BY item
        """,
        "part",
    )


def sql_orders_of_years(spark: SparkSession, folder: str) -> DataFrame:
    return _run(
        spark,
        folder,
        "SELECT text_year(CAST(o_orderdate AS STRING)) AS year, count(*) AS n_orders FROM {orders} GROUP BY 1",
        "orders",
    )


def sql_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """Remainder, bit positions and runs of trailing zeros of every user."""
    return _run(
        spark,
        folder,
        """
        SELECT user, text_remainder(user) AS remainder, array_join(bloom_signature(user), ',') AS positions,
               array_join(distinct_runs(user), ',') AS runs
        FROM (SELECT DISTINCT CAST(user_id AS STRING) AS user FROM {events})
        """,
        "events",
    )


_POSITIONS = ", ".join(f"(x * {a}::BIGINT + 83) % 233333333333 % 5000" for a in (83, 96, 44, 82, 25, 5, 101))
_RUNS = ", ".join(windows.zeros_sql(a, b) for a, b in zip(windows.FM_A, windows.FM_B))

QUERIES = {
    "sql_top_words": Query(sql_top_words, exploration.QUERIES["top_words"].sql),
    "sql_category_parts": Query(
        sql_category_parts,
        "SELECT category, count(*) AS n_parts FROM (SELECT unnest([p_brand, p_type]) AS category FROM part) GROUP BY 1",
    ),
    "sql_orders_of_years": Query(
        sql_orders_of_years,
        "SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS n_orders FROM orders GROUP BY 1",
    ),
    "sql_signatures": Query(
        sql_signatures,
        f"""
        WITH users AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS u FROM events),
        bloom AS (SELECT u, {membership.mod_sql("u", 233333333333)} AS x FROM users),
        runs AS (SELECT u, {membership.mod_sql("u", windows.FM_P)} AS x FROM users)
        SELECT u AS user, bloom.x AS remainder, array_to_string([{_POSITIONS.replace("x *", "bloom.x *")}], ',') AS positions,
               array_to_string([{_RUNS.replace("(x *", "(runs.x *")}], ',') AS runs
        FROM bloom JOIN runs USING (u)
        """,
    ),
}
