"""The functions of this package for SQL texts.

``register`` defines them in a session as functions of SQL expressions, so a statement that uses them is
planned like one that spells them out: no Python runs, filters and columns are pushed down as ever.
Spark takes no such function inside ``explode``; name its result in a subquery first.

| Function | Result |
| --- | --- |
| ``text_tokens(text)`` | lower-cased parts between single spaces, an array |
| ``strip_punctuation(token)`` | the token without punctuation |
| ``text_year(date)`` | the year of a date text ``YYYY-...``, as text |
| ``text_remainder(text)`` | remainder of the text as one integer, for ``bloom_signature`` |
| ``bloom_signature(text)`` | its bit positions in the membership filter, an array |
| ``distinct_runs(text)`` | its runs of trailing zeros under the 12 hashes, an array |
| ``comma_items(list)`` | a table with a row ``item`` for each part of a comma list |
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .hashing import BLOOM_P, FM_P, bloom_positions_of, fm_hashes_of, text_mod_sql, trailing_zeros_sql
from .text import PUNCTUATION

_SPACE = "char(32) || char(9) || char(10) || char(13) || char(12) || char(11)"


def definitions() -> dict[str, str]:
    """Parameters and body of each function, by name."""
    positions = ", ".join(bloom_positions_of("x"))
    runs = ", ".join(trailing_zeros_sql(h) for h in fm_hashes_of("x"))
    hashed = "CASE WHEN nullif(`{0}`, '') IS NULL THEN NULL ELSE transform(array({1}), x -> array({2}))[0] END"
    return {
        "text_tokens": "(text STRING) RETURNS ARRAY<STRING> RETURN split(lower(text), ' ')",
        "strip_punctuation": f"(token STRING) RETURNS STRING RETURN translate(token, '{PUNCTUATION}', '')",
        "text_year": "(date STRING) RETURNS STRING RETURN split(date, '-')[0]",
        "text_remainder": f"(text STRING) RETURNS BIGINT RETURN {text_mod_sql('text', BLOOM_P)}",
        "bloom_signature": f"(text STRING) RETURNS ARRAY<BIGINT> RETURN {hashed.format('text', text_mod_sql('text', BLOOM_P), positions)}",
        "distinct_runs": f"(text STRING) RETURNS ARRAY<INT> RETURN {hashed.format('text', text_mod_sql('text', FM_P), runs)}",
        "comma_items": (
            f"(list STRING) RETURNS TABLE(item STRING) RETURN "
            f"SELECT item FROM (SELECT explode(transform(split(list, ','), part -> trim(BOTH ({_SPACE}) FROM part))) AS item)"
        ),
    }


def register(spark: SparkSession) -> list[str]:
    """Define the functions for a session; returns their names."""
    for name, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(definitions())
