"""Toxicity, quality rules and language: held-out accuracy, plain counts, odd rows."""

import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from odd import base_counts, empty_docs, odd_docs, odd_rows
from siltstone.llm import language, quality, toxicity
from siltstone.llm.labelled import fold, sample

FOLDER = "/root/testdata/sf0.1"


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def labels():
    return pd.read_parquet(f"{FOLDER}/labels.parquet")


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


# toxicity


def test_toxicity_held_out(spark, documents, labels):
    found = driver.queries()["op5_toxicity"](spark, FOLDER).toPandas()
    assert sorted(found.doc_id) == sorted(documents.doc_id)
    assert list(found.held_out) == [crc(i) % 4 == 2 for i in found.doc_id]
    assert found.score.between(0, 1).all()
    assert ((found.score >= 0.3) == (found.predicted == 1)).all()
    held = found[found.held_out].merge(labels, on="doc_id")
    toxic = held.toxic == 1
    assert held[toxic].predicted.mean() > 0.88
    assert held[~toxic].predicted.mean() < 0.005


def test_toxicity_of_odd_rows(spark, labels):
    train = odd_docs(spark, [(i, ("you moron and loser " if i % 2 else "a kind word of ") + f"stone{i}") for i in range(400)])
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(400)] + [(None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    weights = toxicity.fit(train, marks)
    docs = odd_docs(spark, [*odd_rows(), (900, "moron"), (901, "MORON, loser!")])
    rows = docs.select("doc_id", toxicity.score(spark, weights, F.col("text")).alias("s")).collect()
    score = {r.doc_id: r.s for r in rows}
    assert len(rows) == len(odd_rows()) + 2
    assert score[1] == score[2] == score[3]
    assert min(score[900], score[901]) > score[10] + 0.1


def test_toxicity_without_rows(spark):
    weights = toxicity.fit(empty_docs(spark), no_labels(spark))
    assert len(weights.places) == 0
    assert all(0 <= r[0] < 1e-9 for r in odd_docs(spark).select(toxicity.score(spark, weights, F.col("text"))).collect())
    assert empty_docs(spark).select(toxicity.score(spark, weights, F.col("text"))).collect() == []


def test_sample_is_bounded_and_by_hash(spark):
    docs = odd_docs(spark, [(i, f"t{i}") for i in range(500)])
    marks = spark.createDataFrame([(i, 1, 0) for i in range(500)] + [(3, 1, 1)], "doc_id long, quality int, toxic int")
    chosen = sample(docs, marks, "toxic", 100).collect()
    assert len(chosen) == 100
    assert sorted(chosen) == sorted(sample(docs.repartition(7), marks.repartition(3), "toxic", 100).collect())
    assert sample(docs, marks, "toxic", 10_000).count() == 500


def test_sample_looks_for_labels_with_a_document(spark):
    """500 of 100,000 labels have a document; all 500 are found, and the first 100 of them where 100 are asked for."""
    docs = odd_docs(spark, [(200 * i, f"t{i}") for i in range(500)])
    marks = spark.range(100_000).selectExpr("id AS doc_id", "1 AS quality", "CAST(id % 3 = 0 AS int) AS toxic")
    marks = marks.unionByName(marks)
    found = sample(docs, marks, "toxic", 1_000).collect()
    assert sorted((r.text, r.y) for r in found) == sorted((f"t{i}", float(200 * i % 3 == 0)) for i in range(500))
    assert sample(docs, marks, "toxic", 100).collect() == found[:100]


def test_sample_of_an_identifier_that_many_rows_share(spark):
    rows = [(7, f"same {i % 50}") for i in range(3_000)] + [(7, None), (8, None), (9, "nine"), (None, "no id")]
    marks = spark.createDataFrame([(7, 1, 1), (7, 1, 0), (8, 1, 1), (9, 1, 1), (10, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for docs in (odd_docs(spark, rows), odd_docs(spark, rows[::-1]).repartition(5)):
        found = {r.text: r.y for r in sample(docs, marks, "toxic", 100).collect()}
        (own,) = [text for text in found if text and text.startswith("same")]
        assert found == {own: 0.0, None: 1.0, "nine": 1.0}
    assert sample(odd_docs(spark, rows), marks, "toxic", 2).count() == 2


@pytest.mark.parametrize("held", [0, 100, 1_000])
def test_long_rows_are_learnt_from(spark, held):
    """What doesn't fit in memory is spilled: the model is that of all rows."""
    rows = [(i, f"stone{i} river " * (400 if i % 7 == 0 else 12) + ("moron loser" if i % 2 else "kind word")) for i in range(120)]
    docs, marks = odd_docs(spark, rows), spark.createDataFrame([(i, 1 - i % 2, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    spilled, whole = toxicity.fit(docs, marks, held_features=held), toxicity.fit(docs, marks)
    assert len(whole.places) and whole.places.tolist() == spilled.places.tolist()
    assert whole.values.tolist() == spilled.values.tolist() and whole.bias == spilled.bias
    spilled, whole = quality.fit(docs, marks, held_numbers=held), quality.fit(docs, marks)
    assert np.abs(whole.words).max() > 0
    assert whole.words.tolist() == spilled.words.tolist() and whole.runs.tolist() == spilled.runs.tolist()
    assert (whole.bias, whole.slope, whole.shift) == (spilled.bias, spilled.slope, spilled.shift)


def test_fold_of_a_null_id(spark):
    rows = odd_docs(spark, [(None, "a"), (12, "b")]).select("doc_id", fold("doc_id", 4).alias("f")).collect()
    assert {r.doc_id: r.f for r in rows} == {None: zlib.crc32(b"") % 4, 12: crc(12) % 4}


# quality rules


def test_quality_counts_and_verdict(spark, documents, labels):
    found = driver.queries()["op8_quality_rules"](spark, FOLDER).toPandas()
    rows = documents[documents.doc_id % 5 == 0].merge(found, on="doc_id")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert [tuple(r) for r in rows[names].itertuples(index=False)] == [base_counts(t) for t in rows.text]
    failed = (found.n_words < 10) | (100 * found.n_repeat_words > 20 * found.n_words)
    assert (failed == found.base_failed).all()
    assert (found.kept == (~failed & (found.probability >= quality.MIN_PROBABILITY))).all()
    judged = found.merge(labels, on="doc_id")
    good = judged.quality == 1
    assert judged[good & ~judged.base_failed].kept.mean() > 0.995
    assert judged[~good].kept.mean() < 0.05


def test_quality_of_held_out_rows(documents, labels):
    import pyarrow as pa

    rows = documents.merge(labels, on="doc_id")
    train, test = rows[rows.doc_id % 2 == 0], rows[rows.doc_id % 2 == 1]
    model = quality._fit(train.quality.to_numpy(float), quality._frequencies(pa.array(train.text)))
    found = quality._judged(pa.array(test.text), model)
    probability, failed = found.field("probability").to_numpy(), found.field("base_failed").to_numpy(zero_copy_only=False)
    right = (probability >= 0.5) == (test.quality.to_numpy() == 1)
    assert right[~failed].mean() > 0.98
    # Calibrated: the mean probability is the share of good rows.
    assert abs(probability.mean() - test.quality.mean()) < 0.04


def test_quality_of_odd_rows(spark):
    model = quality.fit(empty_docs(spark), no_labels(spark))
    rows = odd_docs(spark).select("text", quality.judge(spark, model, F.col("text")).alias("q")).collect()
    assert [tuple(r.q)[:5] for r in rows] == [base_counts(r.text) for r in rows]
    assert {r.q.probability for r in rows} == {0.5}
    assert empty_docs(spark).select(quality.judge(spark, model, F.col("text"))).collect() == []


def test_quality_sees_phrases_and_characters():
    import pyarrow as pa

    def tables(text):
        places = quality._frequencies(pa.array([text]))[0][0]
        return [set(places[places // quality.PLACES == k].tolist()) for k in range(quality.TABLES)]

    one, two = tables("the river runs to the sea"), tables("the sea runs to the river")
    assert one[0] == two[0] and one[1] != two[1] and one[2] != two[2]
    # A run covers three characters of any length, and none crosses into the next text.
    assert [len(own) for own in tables("漢字かな")] == [1, 0, 0, 2]
    assert [len(own) for own in tables("a🙂")] == [1, 0, 0, 0]
    texts = ["xy", "the 漢字 of stone", "", "z", "é à ü"]
    together = quality._frequencies(pa.array(texts))
    for text, (places, values) in zip(texts, together):
        alone = quality._frequencies(pa.array([text]))[0]
        assert places.tolist() == alone[0].tolist() and values.tolist() == alone[1].tolist()


# language


def test_language_held_out(spark, documents):
    found = driver.queries()["op9_language"](spark, FOLDER).toPandas().merge(documents[["doc_id", "lang"]], on="doc_id")
    assert len(found) == len(documents)
    assert list(found.held_out) == [crc(i) % 3 == 1 for i in found.doc_id]
    assert found.score.between(0, 1).all()
    assert (found[found.held_out].lang_pred == found[found.held_out].lang).mean() > 0.98


def test_language_mixtures_and_odd_rows(spark, documents):
    docs = spark.createDataFrame(documents[["doc_id", "text", "lang"]])
    model = language.fit(docs.unionByName(spark.createDataFrame([(-1, "text", None), (-2, None, "en")], docs.schema)))
    assert model.languages == sorted(documents.lang.unique())
    long = documents[documents.text.str.len().between(2000, 4000)]
    de, es = (long[long.lang == name].text.iloc[0] for name in ("de", "es"))
    rows = [(-1, None), (-2, ""), (-3, "123 !! €"), (-4, "–—…"), (-5, de), (-6, de + " " + es), (-7, "的 é")]
    found = odd_docs(spark, [*odd_rows(), *rows]).select("doc_id", language.identify(spark, model, F.col("text")).alias("l")).collect()
    by_id = {r.doc_id: r.l for r in found if r.doc_id is not None and r.doc_id < 0}
    assert all(tuple(by_id[i]) == ("und", 0.0, "") for i in (-1, -2, -3, -4))
    assert by_id[-5].lang_pred == "de" and by_id[-5].score > 0.9
    assert {"de", "es"} <= set(by_id[-6].languages.split(",")) and by_id[-6].score < 0.8
    assert by_id[-7].lang_pred in model.languages


def test_language_without_rows(spark):
    model = language.fit(empty_docs(spark))
    assert model.languages == []
    assert {r[0].lang_pred for r in odd_docs(spark).select(language.identify(spark, model, F.col("text"))).collect()} == {"und"}


def test_language_doesnt_depend_on_batches(documents):
    import pyarrow as pa

    from siltstone.llm.spans import texts

    model = language.Model(["x", "y"], language.np.log(language.np.random.default_rng(1).dirichlet([1.0] * language.PLACES, 2)).astype("f4"))
    column = pa.array(documents.text[:40])
    whole = language._chosen(column, model).to_pylist()
    assert whole == [row for i in range(40) for row in language._chosen(column.slice(i, 1), model).to_pylist()]
    assert texts(column.slice(3, 1))[0].tobytes().decode() == documents.text[3]


