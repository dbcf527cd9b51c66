"""The checks on fitted models fail where they should; every document is accounted for."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from sortilex.operators import ClassifierParams, fit_classifier, score_batch
from sortilex.plans import label_coverage

NAMES = ("a", "b")


@pytest.fixture(scope="module")
def cut(spark):
    rows = [(i, ["red red blue", "green é blue"][i % 2] + f" x{i % 3}") for i in range(20)]
    return spark.createDataFrame([*rows, (20, ""), (21, None)], "doc_id long, truncated_text string")


@pytest.fixture(scope="module")
def models(cut):
    train = cut.filter("doc_id < 20").withColumn("label", (F.col("doc_id") % 2).cast("int"))
    params = ClassifierParams(num_features=64)
    other = train.withColumn("label", 1 - F.col("label"))
    return tuple(fit_classifier(rows, params, (*NAMES, "c")) for rows in (train, other))


def outcomes(checked):
    columns = ("scored_once", "named", "bounded", "right")
    return {c: {r["doc_id"] for r in checked.collect() if not r[c]} for c in columns}


def test_right_scores_pass(cut, models):
    names = (*NAMES, "c")
    checked = driver.checked_scores(score_batch(cut, models[0], names), cut, models[0], names)
    assert checked.count() == 22 and not any(outcomes(checked).values())


def test_another_model_is_found_out(cut, models):
    names = (*NAMES, "c")
    checked = driver.checked_scores(score_batch(cut, models[1], names), cut, models[0], names)
    assert outcomes(checked)["right"] == set(range(20))


def test_lost_repeated_and_misnamed_rows_are_found_out(cut, models):
    names = (*NAMES, "c")
    scored = score_batch(cut, models[0], names)
    wrong = F.when(F.col("doc_id") == 3, "c").otherwise(F.col("predicted_category"))
    scored = scored.filter("doc_id <> 1").unionByName(scored.filter("doc_id = 2"))
    scored = scored.withColumn("predicted_category", wrong)
    failed = outcomes(driver.checked_scores(scored, cut, models[0], names))
    assert failed["scored_once"] == {1, 2} and failed["named"] == {1, 3} and failed["right"] == {1}


def test_label_coverage_counts_every_row(spark):
    docs = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "doc_id long")
    labels = spark.createDataFrame([(1,), (4,), (4,), (None,)], "doc_id long")
    row = label_coverage(docs, labels).first()
    assert tuple(row) == (5, 4, 3, 3)
    assert tuple(label_coverage(docs.limit(0), labels.limit(0)).first()) == (0, 0, 0, 0)


def test_terms_are_summed_where_they_are(cut, models, plan):
    """A document moves as one row of sums; its terms do not, nor are they hashed twice."""
    found = driver.recomputed_probabilities(cut, models[0])
    got = plan(found)
    # Keys alone: by document, and nothing by term or by feature.
    keys = [line.split("hashpartitioning(")[1].split("#")[0] for line in got.splitlines() if "hashpartitioning(" in line]
    assert keys == ["doc_id"]
    assert got.count("regexp_extract(") == 1
    # Repeated terms count as often as they occur: "red red blue".
    own = {r.doc_id: r.probability for r in models[0].transform(cut.filter("doc_id < 20")).collect()}
    rows = {r.doc_id: r.p for r in found.collect()}
    assert rows.keys() == own.keys()
    assert all(abs(a - b) < 1e-9 for i, p in rows.items() for a, b in zip(p, own[i], strict=True))


def test_a_document_is_hashed_whole(spark, models, plan):
    """Its terms are spread over rows after the hashing, as counts by feature."""
    rows = [(0, "red " * 11 + "blue"), (1, "é"), (2, "  red   blue "), (3, ""), (4, None), (5, " ")]
    cut = spark.createDataFrame(rows, "doc_id long, truncated_text string")
    found = driver.recomputed_probabilities(cut, models[0])
    operators = plan(found).split("\n(1) ")[1]
    assert 0 < operators.index("UDF(") < operators.index("Generate")
    own = {r.doc_id: r.probability for r in models[0].transform(cut).collect()}
    got = {r.doc_id: r.p for r in found.collect()}
    assert got.keys() == {0, 1, 2}
    assert all(abs(a - b) < 1e-9 for i, p in got.items() for a, b in zip(p, own[i], strict=True))
