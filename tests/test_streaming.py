import pytest
from pyspark.sql import functions as F

from sortilex.operators import (
    ClassifierParams,
    encode_category,
    fit_classifier,
    score_batch,
    truncate_documents,
)
from sortilex.streaming import score_stream, stream_documents

LANGS = ("de", "en", "es", "fr")
DOCS = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def cut(spark):
    docs = spark.read.parquet(DOCS)
    return truncate_documents(docs).select("doc_id", "truncated_text", "lang")


@pytest.fixture(scope="module")
def model(spark, cut):
    train = encode_category(cut, "lang", LANGS)
    return fit_classifier(train, ClassifierParams(num_features=1 << 10, max_iter=5), LANGS)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_stream_equals_batch_over_micro_batches(spark, cut, model, tmp_path):
    arriving = str(tmp_path / "in")
    cut.repartition(3).write.parquet(arriving)
    stream = stream_documents(spark, arriving, cut.schema, max_files_per_trigger=1)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    query = score_stream(stream, model, out, checkpoint, LANGS, name="stg_test")
    query.awaitTermination()
    assert query.name == "stg_test"
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert rows(spark.read.parquet(out)) == rows(score_batch(cut, model, LANGS))


def test_a_restart_scores_only_new_files(spark, cut, model, tmp_path):
    arriving, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    parts = [cut.filter(F.col("doc_id") % 2 == i) for i in (0, 1)]
    for part in parts:
        part.write.mode("append").parquet(arriving)
        stream = stream_documents(spark, arriving, cut.schema)
        score_stream(stream, model, out, checkpoint, LANGS).awaitTermination()
    stream = stream_documents(spark, arriving, cut.schema)
    score_stream(stream, model, out, checkpoint, LANGS).awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(score_batch(cut, model, LANGS))


def test_a_running_query(spark, cut, model, tmp_path):
    arriving = str(tmp_path / "in")
    cut.write.parquet(arriving)
    stream = stream_documents(spark, arriving, cut.schema)
    out = str(tmp_path / "out")
    query = score_stream(
        stream, model, out, str(tmp_path / "cp"), LANGS, trigger={"processingTime": "1 second"}
    )
    try:
        query.processAllAvailable()
        cut.limit(5).write.mode("append").parquet(arriving)
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert spark.read.parquet(out).count() == cut.count() + 5


def test_a_function_as_model(spark, cut, tmp_path):
    arriving, out = str(tmp_path / "in"), str(tmp_path / "out")
    cut.write.parquet(arriving)
    stream = stream_documents(spark, arriving, cut.schema)
    score = lambda df: df.select("doc_id", F.lit(1).alias("prediction"))
    score_stream(stream, score, out, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(out).filter("prediction = 1").count() == cut.count()


def test_the_stream_keeps_no_state(spark, cut, model, tmp_path):
    arriving = str(tmp_path / "in")
    cut.write.parquet(arriving)
    stream = stream_documents(spark, arriving, cut.schema)
    query = score_stream(stream, model, str(tmp_path / "out"), str(tmp_path / "cp"), LANGS)
    query.awaitTermination()
    assert all(not p["stateOperators"] for p in query.recentProgress)
