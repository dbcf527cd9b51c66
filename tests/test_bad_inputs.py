"""Rows that a user's model cannot take, and rows that have no language."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from sortilex.operators import score_batch_udf
from sortilex.streaming import score_stream

NAMES = ("a", "b")
ROWS = [(1, [0.1, 0.9]), (2, None), (3, [0.1]), (4, [0.5, None]), (5, [0.9, 0.1])]
WANT = {1: (1, "b", 0.9), 2: (None,) * 3, 3: (None,) * 3, 4: (None,) * 3, 5: (0, "a", 0.9)}


def model(n_scores):
    def make():
        def predict(x):
            return np.repeat(x.astype("float64"), n_scores // 2, axis=1)

        return predict

    return make


def score(df, n_scores=2):
    return score_batch_udf(df, model(n_scores), ["x"], NAMES, input_tensor_shapes=[[2]])


def as_dict(df):
    return {r.id: (r.prediction, r.predicted_category, r.confidence) for r in df.collect()}


def test_rows_that_cannot_be_scored_stay_with_null_scores(spark):
    df = spark.createDataFrame(ROWS, "id int, x array<double>")
    assert as_dict(score(df)) == WANT


def test_the_stream_survives_them_too(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "id int, x array<double>")
    df.write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    score_stream(arriving, score, out, str(tmp_path / "progress")).awaitTermination()
    assert as_dict(spark.read.parquet(out)) == WANT


def test_more_scores_than_categories_are_refused(spark):
    df = spark.createDataFrame(ROWS, "id int, x array<double>")
    with pytest.raises(Exception, match="more scores"):
        score(df, 4).collect()


def test_a_null_language_is_written_too(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 7 != 0, F.col("lang")))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    first = driver.write_and_read(spark, str(tmp_path))
    assert driver.write_and_read(spark, str(tmp_path)).count() == first.count() == docs.count()
