import random

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sortilex.operators import (
    ClassifierParams,
    encode_category,
    fit_classifier,
    fit_unsaved,
    load_classifier,
    score_batch,
    score_batch_udf,
    score_texts_by_length,
    truncate_documents,
)

NAMES = ("food", "never", "sport", "tech")
TEXTS = {
    "food": ["soup rice bread", "bread and soup", "rice with salt", "hot soup salt"],
    "sport": ["goal match team", "team wins match", "goal in the match", "a team run"],
    "tech": ["chip code cloud", "code on a chip", "cloud code", "new chip cloud"],
}
PARAMS = ClassifierParams(num_features=64, max_iter=20, reg_param=0.01)


def examples(spark, texts):
    rows = [(t, c) for c, ts in texts.items() for t in ts]
    return spark.createDataFrame(rows, "truncated_text string, category string")


@pytest.fixture(scope="module")
def model(spark):
    return fit_classifier(encode_category(examples(spark, TEXTS), "category", NAMES), PARAMS, NAMES)


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_the_model_knows_the_whole_domain(model):
    assert model.stages[-1].numClasses == len(NAMES)


def test_scores(spark, model):
    df = spark.createDataFrame(
        [(1, "salt soup"), (2, "match goal"), (3, "cloud chip"), (4, None), (5, ""), (6, "zzz")],
        "id int, truncated_text string",
    )
    got = {r.id: r for r in score_batch(df, model, NAMES).collect()}
    assert len(got) == 6
    assert [got[i].predicted_category for i in (1, 2, 3)] == ["food", "sport", "tech"]
    assert [got[i].prediction for i in (1, 2, 3)] == [0, 2, 3]
    assert all(1 / len(NAMES) < got[i].confidence <= 1 for i in (1, 2, 3))
    assert [tuple(got[i])[2:] for i in (4, 5)] == [(None, None, None)] * 2
    assert got[6].prediction is not None


def test_confidence_is_the_probability_of_the_prediction(spark, model):
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([("salt soup team",), ("goal code",)], "truncated_text string")
    raw = model.transform(df).select(
        F.get(vector_to_array("probability"), F.col("prediction").cast("int")).alias("p")
    )
    assert [r.p for r in raw.collect()] == [r.confidence for r in score_batch(df, model, NAMES).collect()]


def test_save_load_score(spark, model, tmp_path):
    path = str(tmp_path / "model")
    train = encode_category(examples(spark, TEXTS), "category", NAMES)
    fit_classifier(train.limit(3), PARAMS, NAMES, path=path)
    fitted = fit_unsaved(train, PARAMS, NAMES)
    cut = train.select("truncated_text")
    before = as_rows(score_batch(cut, fitted, NAMES))
    fitted.write().overwrite().save(path)
    assert as_rows(score_batch(cut, load_classifier(path), NAMES)) == before
    fit_classifier(train.limit(3), PARAMS, NAMES, path=path)
    assert as_rows(score_batch(cut, load_classifier(path), NAMES)) != before


def test_rows_without_a_label_are_not_used(spark, model):
    train = encode_category(
        examples(spark, {**TEXTS, "unknown": ["soup soup soup"], None: ["bread"]}), "category", NAMES
    )
    again = fit_classifier(train, PARAMS, NAMES)
    first, second = (m.stages[-1].coefficientMatrix.toArray() for m in (model, again))
    assert abs(first - second).max() < 1e-9


def test_japanese_text_in_characters(spark):
    texts = {
        "food": ["今日の晩御飯は味噌汁です", "味噌汁と御飯が好き", "朝御飯に味噌汁"],
        "sport": ["野球の試合に勝った", "試合は野球場で", "次の野球の試合"],
        "tech": ["新型の電話機を発売", "電話機の新型が出た", "発売された電話機"],
    }
    docs = examples(spark, texts).withColumnRenamed("truncated_text", "text")
    train = encode_category(truncate_documents(docs, 128, "char"), "category", NAMES)
    params = ClassifierParams(unit="char", num_features=256, max_iter=20, reg_param=0.01)
    model = fit_classifier(train, params, NAMES)
    new = spark.createDataFrame(
        [(1, "御飯と味噌汁"), (2, "野球の試合"), (3, "新型電話機")], "id int, truncated_text string"
    )
    got = {r.id: r.predicted_category for r in score_batch(new, model, NAMES).collect()}
    assert got == {1: "food", 2: "sport", 3: "tech"}


def test_character_terms_are_overlapping_pairs(spark):
    params = ClassifierParams(unit="char", num_features=64, max_iter=1)
    df = spark.createDataFrame([(0, "ab"), (1, "𠮷野\n家"), (1, ""), (0, None)], "label int, truncated_text string")
    model = fit_classifier(df, params, NAMES)
    got = [r.terms for r in model.stages[0].transform(df).collect()]
    assert got == [["ab", "b"], ["𠮷野", "野\n", "\n家", "家"], [], []]


def test_ids_equal_those_of_a_label_indexer(spark):
    """Class ids are positions, as an indexer built from the same list gives."""
    df = spark.createDataFrame([("tech",), ("food",), ("sport",), ("other",)], "category string")
    indexer = StringIndexerModel.from_labels(
        list(NAMES), inputCol="category", outputCol="index", handleInvalid="keep"
    )
    got = indexer.transform(encode_category(df, "category", NAMES)).collect()
    assert [(r.label, int(r["index"])) for r in got] == [(3, 3), (0, 0), (2, 2), (None, 4)]


def test_better_than_the_majority_class(spark):
    from sortilex.plans import prepare_examples

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs = ("de", "en", "es", "fr")
    marked = prepare_examples(docs, "lang", langs).cache()
    model = fit_classifier(marked.filter("split = 'train'"), categories=langs)
    test = score_batch(marked.filter("split = 'test'"), model, langs)
    right, majority, n = test.agg(
        F.count_if(F.col("label") == F.col("prediction")), F.count_if(F.col("label") == 1), F.count("*")
    ).first()
    assert n > 150
    assert right / n > majority / n + 0.2
    marked.unpersist()


def test_two_classes_after_an_observation(spark):
    """A session that observes metrics can still score with a binary model."""
    df = spark.createDataFrame([(0, "soup"), (1, "goal")], "label int, truncated_text string")
    seen = Observation("seen")
    df.observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 2}
    model = fit_classifier(df, ClassifierParams(num_features=16, max_iter=2), ("food", "sport"))
    assert [r.prediction for r in score_batch(df, model, ("food", "sport")).collect()] == [0, 1]


@pytest.mark.parametrize("taken", ["prediction", "confidence", "features"])
def test_taken_names_are_refused(spark, model, taken):
    df = spark.createDataFrame([("a", 1)], f"truncated_text string, {taken} int")
    with pytest.raises(ValueError):
        score_batch(df, model, NAMES)


def test_user_model(spark):
    def make_predict_fn():
        def predict(text):
            import numpy as np

            lengths = np.array([len(t) for t in text], dtype="float64")
            return np.stack([lengths * 0 + 2, lengths, lengths * 0], axis=1)

        return predict

    df = spark.createDataFrame([(1, "a"), (2, "ab"), (3, "abc")], "id int, text string")
    got = score_batch_udf(df, make_predict_fn, ["text"], ("x", "y", "z"), batch_size=2)
    # Equal scores: the class that comes first in the domain wins.
    assert as_rows(got) == [
        (1, "a", 0, "x", 2.0),
        (2, "ab", 0, "x", 2.0),
        (3, "abc", 1, "y", 3.0),
    ]


def test_texts_by_length_score_as_the_udf_does_and_pad_less(spark, tmp_path):
    rng = random.Random(2)
    texts = ["x" * rng.choice([1, 3, 50, 400]) + str(i) for i in range(900)] + [None, "", "é" * 7]
    rows = [(i, t, "kept") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, truncated_text string, more string").repartition(2)
    padded = spark.sparkContext.accumulator(0)

    def make():
        def predict(texts):
            lengths = np.array([len(t) for t in texts])
            padded.add(int((lengths.max() - lengths).sum()))
            return np.stack([lengths, 100 - lengths], axis=1).astype(float)

        return predict

    names = ("long", "short")
    by_length = score_texts_by_length(df, make, categories=names, batch_size=32)
    sorted_rows = sorted(map(tuple, by_length.collect()))
    less, start = padded.value, padded.value
    plain = score_batch_udf(df, make, ["truncated_text"], names, batch_size=32)
    scorable = sorted(tuple(r) for r in plain.filter("truncated_text <> ''").collect())
    more = padded.value - start
    assert [r for r in sorted_rows if r[1]] == scorable
    assert [r[3:] for r in sorted_rows if not r[1]] == [(None, None, None)] * 2
    assert less * 5 < more
    small = score_texts_by_length(df, make, categories=names, batch_size=7, buffer_rows=10)
    assert sorted(map(tuple, small.collect())) == sorted_rows
    with pytest.raises(Exception, match="more scores than"):
        score_texts_by_length(df, make, categories=("one",)).collect()
