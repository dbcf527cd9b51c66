"""Whole jobs, and the physical plans of all of them."""

import re

import pytest
from pyspark.sql import functions as F

from sortilex import Settings
from sortilex.operators import (
    ClassifierParams,
    class_metrics,
    confusion_matrix,
    count_terms,
    encode_category,
    fit_classifier,
    load_classifier,
    matrix_counts,
    reject_unknown_category,
    score_batch,
    split_examples,
    truncate_documents,
)
from sortilex.plans import (
    attach_labels,
    count_examples,
    fit_and_evaluate,
    prepare_examples,
    score_table,
    serve,
    train,
)
from sortilex.sources import read_metrics
from sortilex.streaming import stream_documents

SF = "/root/testdata/sf0.001"
NAMES = ("a", "b")
DOCS = [
    (1, "one two three", "a"),
    (2, "one two four", "b"),
    (3, None, "a"),
    (4, "  ", "a"),
    (5, "one", "c"),
    (6, "", None),
]


def exchanges(text):
    return re.findall(r"\(\d+\) (\w*Exchange)", text.split("===")[-1])


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id int, text string, category string")


@pytest.fixture
def stored_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_prepare_examples(docs):
    got = prepare_examples(docs, "category", NAMES, max_length=2).collect()
    assert {(r.doc_id, r.truncated_text, r.label) for r in got} == {(1, "one two", 0), (2, "one two", 1)}
    assert len({r.split for r in got}) == 1


@pytest.mark.parametrize("unit", ["token", "char"])
def test_every_document_is_counted_once(docs, unit):
    r = count_examples(docs, "category", NAMES, max_length=2, unit=unit).first()
    assert r.documents == len(DOCS) == r.unknown_category + r.no_text + r.train + r.test
    # Two blanks are text where characters count, and no text where tokens do.
    assert (r.unknown_category, r.no_text) == (2, 2 if unit == "token" else 1)
    prepared = prepare_examples(docs, "category", NAMES, max_length=2, unit=unit)
    marks = {x["split"]: x["count"] for x in prepared.groupBy("split").count().collect()}
    assert (marks.get("train", 0), marks.get("test", 0)) == (r.train, r.test)


def test_train_score_and_serve(spark, stored_docs, tmp_path):
    langs = ("de", "en", "es", "fr")
    settings = Settings(
        "spark_catalog", "default", "langs", "run1", "langs", str(tmp_path), categories=langs
    )
    params = ClassifierParams(num_features=1 << 10)
    model, metrics = train(stored_docs, "lang", settings, params)
    assert metrics.filter("category is not null").count() == 24
    counts = {r.metric: r.value for r in metrics.filter("category is null").collect()}
    assert (counts.pop("unscored"), counts.pop("out_of_domain")) == (0, 0)
    assert counts == count_examples(stored_docs, "lang", langs).first().asDict()
    assert counts["documents"] == stored_docs.count()
    assert {r.run_id for r in metrics.collect()} == {"run1"}
    again, _ = train(stored_docs, "lang", settings, params)
    with pytest.raises(ValueError):
        train(stored_docs, "lang", settings, ClassifierParams(unit="char"))
    assert read_metrics(spark, settings.metrics_path).count() == 29

    scored = score_table(stored_docs, load_classifier(settings.model_path), settings)
    assert scored.count() == stored_docs.count()
    assert "text" not in scored.columns and "truncated_text" in scored.columns
    right = scored.filter("lang = predicted_category").count()
    assert right / scored.count() > 0.8

    arriving = str(tmp_path / "arriving")
    stored_docs.write.parquet(arriving)
    stream = stream_documents(spark, arriving, stored_docs.schema)
    for endpoint in (settings.stg_serving_endpoint_name, settings.prod_serving_endpoint_name):
        serve(stream, again, settings, endpoint).awaitTermination()
        served = spark.read.parquet(settings.scores_path(endpoint))
        assert sorted(served.collect()) == sorted(score_table(stored_docs, again, settings).collect())


@pytest.mark.parametrize("partitions", [None, 3])
def test_partitions_bound_the_tasks_of_the_fit(spark, stored_docs, tmp_path, partitions):
    """The examples stay where the scan has them, and the result does not change."""
    copies = stored_docs.select("doc_id", F.lit("the same text").alias("truncated_text"), "lang")
    examples = encode_category(copies, "lang", ("de", "en", "es", "fr")).drop("lang")
    examples = split_examples(examples, "doc_id").repartition(5)
    params = ClassifierParams(num_features=64, max_iter=1, partitions=partitions)
    path = str(tmp_path / "examples")
    _, metrics = fit_and_evaluate(examples, path, params, ("de", "en", "es", "fr"))
    assert metrics.agg(F.sum("support"), F.sum("predicted")).first() == (
        examples.filter("split = 'test'").count(),
    ) * 2
    sizes = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 2 * 5
    with pytest.raises(ValueError):
        ClassifierParams(partitions=0)


def test_stored_counts_give_the_same_model(spark, stored_docs, tmp_path):
    """Hashed terms read back from files fit the model that the texts fit."""
    langs = ("de", "en", "es", "fr")
    examples = prepare_examples(stored_docs, "lang", langs)
    params = ClassifierParams(num_features=256, max_iter=5)
    count_terms(examples, params).coalesce(1).write.parquet(str(tmp_path / "c"))
    examples.coalesce(1).write.parquet(str(tmp_path / "t"))
    models = [fit_classifier(spark.read.parquet(str(tmp_path / x)), params, langs) for x in "ct"]
    weights = [m.stages[-1].coefficientMatrix.toArray() for m in models]
    assert abs(weights[0] - weights[1]).max() < 1e-9


def test_preparing_examples_neither_shuffles_nor_caches(spark, stored_docs, plan):
    prepared = count_terms(prepare_examples(stored_docs, "source", ("src0", "src1")))
    assert exchanges(plan(prepared)) == ["BroadcastExchange"]
    fit_classifier(prepare_examples(stored_docs, "lang", ("de", "en", "es", "fr")), ClassifierParams(max_iter=1))
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_train_reads_the_documents_once(spark, tmp_path, monkeypatch):
    """The counts come from the job that writes the examples, and rows left out are counted."""
    schema = "doc_id long, text string, category string"
    rows = [(i, f"red w{i}" if i % 2 else f"blue w{i}", "ab"[i % 2]) for i in range(60)]
    rows += [(100, None, "a"), (101, "  ", "b"), (102, "some", "zzz"), (103, "some", None)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "d"))
    reads = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    documents = spark.read.parquet(str(tmp_path / "d"))
    documents = documents.mapInArrow(counting, documents.schema)
    settings = Settings("c", "s", "m", "r", "e", str(tmp_path / "p"), categories=("a", "b"))
    _, stored = train(documents, "category", settings, ClassifierParams(num_features=32, max_iter=3))
    counts = {r.metric: r.value for r in stored.filter("category is null").collect()}
    assert reads.value == len(rows) == counts["documents"]
    assert (counts["no_text"], counts["unknown_category"]) == (2, 2)
    assert (counts["unscored"], counts["out_of_domain"]) == (0, 0)
    assert counts["train"] + counts["test"] == 60


def test_rows_that_no_class_counts(spark):
    pairs = [(0, 0), (0, None), (None, 1), (5, 1), (1, 7), (None, None), (1, 1)]
    matrix = confusion_matrix(spark.createDataFrame(pairs, "label int, prediction int"))
    assert matrix_counts(matrix, NAMES).first() == (7, 2, 4)
    empty = confusion_matrix(spark.createDataFrame([], "label int, prediction int"))
    assert matrix_counts(empty, NAMES).first() == (0, 0, 0)


# --- physical plans ----------------------------------------------------------


def test_row_local_operators_do_not_shuffle(stored_docs, plan):
    cut = truncate_documents(stored_docs)
    for df in (cut, truncate_documents(stored_docs, unit="char"), split_examples(cut, "truncated_text")):
        text = plan(df)
        assert "Exchange" not in text and "Python" not in text
    prepared = plan(prepare_examples(stored_docs, "source", ("src0", "src1")))
    assert exchanges(prepared) == ["BroadcastExchange"]
    assert "Python" not in prepared


def test_scans_read_only_what_is_used(stored_docs, plan):
    encoded = encode_category(stored_docs, "source", ("src0",)).select("doc_id", "label")
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan(encoded)
    assert "ReadSchema: struct<text:string>" in plan(truncate_documents(stored_docs).select("truncated_text"))


def test_the_domain_is_pushed_to_the_scan(stored_docs, plan):
    valid, _ = reject_unknown_category(stored_docs, "source", ("src0", "src1"))
    assert re.search(r"PushedFilters: \[.*In\(source, \[src0,src1\]\)", plan(valid))


def test_an_unselected_length_is_not_computed(stored_docs, plan):
    cut = truncate_documents(stored_docs)
    assert "split(text" not in plan(cut.select("truncated_text", "was_truncated"))
    assert "split(text" in plan(cut.select("n_units"))


def test_evaluation_aggregates_before_it_shuffles(spark, tmp_path, plan):
    path = str(tmp_path / "scored")
    spark.range(100).selectExpr("cast(id % 2 as int) label", "cast(id % 3 as int) prediction").write.parquet(path)
    scored = spark.read.parquet(path)
    matrix = plan(confusion_matrix(scored))
    assert matrix.count("partial_count") >= 1 and exchanges(matrix) == ["Exchange"]
    metrics = plan(class_metrics(scored, ("a", "b", "c")))
    assert "Join" not in metrics
    # The rows are expanded to their two classes after they are counted.
    assert metrics.index("partial_count") < metrics.index("Arguments: inline(")


def test_whole_texts_are_not_shuffled(spark, stored_docs, plan):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(attach_labels(stored_docs, labels).select("doc_id", "truncated_text", "quality"))
        inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)
        assert "SortMergeJoin" in text
        assert len(inputs) == 2
        assert "truncated_text" in inputs[0] and not re.search(r"\btext#", inputs[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def small_partitions(spark):
    """Settings under which the skew of a test table counts as skew."""
    changes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in changes.items():
        spark.conf.set(key, value)
    yield
    for key in changes:
        spark.conf.unset(key)


def test_a_dominant_join_key_is_split(spark, small_partitions, plan):
    """A third of the documents under one id: AQE shares them among tasks."""
    docs = spark.range(0, 60_000, 1, 16).selectExpr(
        "if(id % 3 = 0, 7, id) as doc_id", "sha2(string(id), 512) as text"
    )
    labels = spark.range(60_000).selectExpr("id as doc_id", "int(id % 2) as quality")
    joined = attach_labels(docs, labels)
    rows = joined.select("doc_id", "truncated_text", "quality").collect()
    assert len(rows) == 60_000 and sum(r.doc_id == 7 for r in rows) == 20_001
    joined.collect()
    assert "skew=true" in plan(joined)


def test_a_dominant_unknown_category_is_split(spark, small_partitions, plan):
    """The same where a domain is too large to broadcast."""
    docs = spark.range(0, 60_000, 1, 16).selectExpr(
        "sha2(string(id), 512) as text", "if(id % 3 = 0, 'unknown', concat('c', id % 500)) as name"
    )
    encoded = encode_category(docs, "name", tuple(f"c{i}" for i in range(500)))
    rows = encoded.collect()
    assert len(rows) == 60_000 and sum(r.label is None for r in rows) == 20_000
    assert "skew=true" in plan(encoded)


def test_each_text_is_cut_once(stored_docs, plan):
    text = plan(prepare_examples(stored_docs, "source", ("src0",)))
    conditions = re.findall(r"Condition : (.*)", text)
    assert conditions and not any("regexp_extract" in c for c in conditions)
    assert text.count(" AS truncated_text") == 1


def test_scoring_does_not_shuffle(spark, stored_docs, plan, tmp_path):
    from sortilex.operators import fit_classifier

    cut = truncate_documents(stored_docs).select("doc_id", "truncated_text")
    train_rows = cut.withColumn("label", (F.col("doc_id") % 2).cast("int"))
    model = fit_classifier(train_rows, ClassifierParams(num_features=64, max_iter=1), NAMES)
    text = plan(score_batch(cut, model, NAMES))
    assert "Exchange" not in text and "Python" not in text
