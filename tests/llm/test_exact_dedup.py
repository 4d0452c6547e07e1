import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from odd import empty_docs, odd_docs, odd_rows, rows_of
from siltstone.llm import exact_dedup as exact_dedup_module
from siltstone.llm.exact_dedup import exact_dedup, without_copies
from siltstone.session import written

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def plain(rows, largest):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    found = []
    for text, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, -i if largest and i is not None else i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        found += [(i, ids[0], len(ids), k == 0, sha) for k, i in enumerate(ids)]
    return sorted(found, key=repr)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_odd_rows(spark, keep):
    rows = odd_rows()
    assert rows_of(exact_dedup(odd_docs(spark), keep=keep), *COLUMNS) == plain(rows, keep == "largest")


def test_one_text_over_many_partitions(spark):
    rows = [(i, "the same text") for i in range(3000)] + [(5000 + i, f"text {i}") for i in range(500)]
    assert rows_of(exact_dedup(odd_docs(spark, rows).repartition(6)), *COLUMNS) == plain(rows, False)


def test_repeated_rows_keep_exactly_one(spark):
    found = exact_dedup(odd_docs(spark, [(1, "a")] * 700)).groupBy("kept").count().collect()
    assert {row.kept: row["count"] for row in found} == {True: 1, False: 699}


@pytest.mark.parametrize("doc_id", [None, 7])
def test_one_text_without_identifiers_is_spread(spark, monkeypatch, doc_id):
    """Equal rows fill all partitions, and leave their task in slices."""
    seen = []
    monkeypatch.setattr(exact_dedup_module, "written", lambda df, label: seen.append(written(df, label)) or seen[-1])
    monkeypatch.setattr(exact_dedup_module, "SLICE_ROWS", 300)
    rows = [(doc_id, "one text"), (3, "another"), (None, "third")]
    docs = odd_docs(spark, rows).withColumn("copies", F.when(F.col("text") == "one text", 20_000).otherwise(2))
    docs = docs.select("*", F.explode(F.sequence(F.lit(1), "copies"))).drop("col", "copies")
    found = exact_dedup(docs)
    kept = {(r.text_sha256, r.kept): r.n for r in found.groupBy("text_sha256", "kept").agg(F.count("*").alias("n")).collect()}
    sha = {text: hashlib.sha256(text.encode()).hexdigest() for _, text in rows}
    assert kept == {(sha["one text"], True): 1, (sha["one text"], False): 19_999, **{(sha[t], k): 1 for t in ("another", "third") for k in (True, False)}}
    assert {r.group_size for r in found.where(F.col("text_sha256") == sha["one text"]).collect()} == {20_000}
    sizes = [r["count"] for r in seen[0].groupBy("part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8


def test_normalised(spark):
    rows = [(1, "A  b"), (2, "a b"), (3, "a c")]
    found = exact_dedup(odd_docs(spark, rows), normalise=lambda text: F.lower(F.regexp_replace(text, " +", " ")))
    assert rows_of(found, "doc_id", "keep_id", "kept") == [(1, 1, True), (2, 1, False), (3, 3, True)]


def test_rows_without_copies_keep_all_columns(spark):
    docs = odd_docs(spark)
    found = without_copies(docs)
    assert found.columns == docs.columns and found.dtypes == docs.dtypes
    kept = sorted((i, s) for i, _, _, k, s in plain(odd_rows(), False) if k and i is not None)
    got = sorted((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in found.collect() if r.doc_id is not None)
    assert got == kept
    assert found.exceptAll(docs).count() == 0


def test_empty(spark):
    assert exact_dedup(empty_docs(spark)).collect() == []
    assert without_copies(empty_docs(spark)).collect() == []


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        exact_dedup(empty_docs(spark), keep="first")
