"""

The test tables carry no categories of their own. ``source`` stands in for the
category column where the closed domain is checked: nine of its twenty values
are the domain, the others are unknown. ``lang`` is what the classifier learns
from text, and ``labels.quality`` is the label where a fixed rule predicts, so
that SQL can check the metrics.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import partial, reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sortilex import Settings  # noqa: E402
from sortilex.operators import (  # noqa: E402
    ClassifierParams,
    category_domain,
    class_metrics,
    confusion_matrix,
    decode_category,
    encode_category,
    fit_classifier,
    fit_unsaved,
    load_classifier,
    long_metrics,
    reject_unknown_category,
    score_batch,
    score_batch_udf,
    score_texts_by_length,
    split_examples,
    truncate_documents,
)
from sortilex.plans import (  # noqa: E402
    ModelVersions,
    attach_labels,
    count_examples,
    fit_and_evaluate,
    ingest_documents,
    label_coverage,
    load_registered,
    prepare_examples,
    read_promoted,
    score_table,
    score_to_endpoint,
    serve,
    serve_promoted,
    train,
    with_text,
)
from sortilex.sources import (  # noqa: E402
    DocumentStore,
    ingest_text_files,
    read_documents,
    read_metrics,
    record_metrics,
    write_documents,
)
from sortilex.storage import run_folder, shuffles_removed  # noqa: E402
from sortilex.streaming import score_stream, stream_documents  # noqa: E402

# The operators for training data can be taken out as a whole.
try:
    import corpus_pipeline
    from sortilex.llm.queries import llm_queries, llm_sql
except ModuleNotFoundError as missing:
    # Any other module that is missing is an error.
    if missing.name != "corpus_pipeline" and not missing.name.startswith("sortilex.llm"):
        raise
    corpus_pipeline = None

SOURCES = tuple(f"src{i}" for i in range(9))
LANGS = ("de", "en", "es", "fr")
QUALITIES = ("low", "high", "unseen")
WORD_LIMIT = 128
STORE_BUCKETS = 16


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, path=f"{sf_dir}/documents.parquet")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _arriving(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a stream; its schema comes from the batch table."""
    schema = _table(spark, sf_dir, name).schema
    # A stream reads folders. The pattern names the table alone and lets it be
    # one file or a folder of files.
    return stream_documents(spark, f"{sf_dir}/{name}.parque[t]", schema)


# --- sources and sinks -------------------------------------------------------


def read_all(spark, sf_dir):
    return _documents(spark, sf_dir)


def write_and_read(spark, sf_dir):
    """Overwrite the table with one half of the documents, append the other half."""
    docs = _documents(spark, sf_dir)
    path = run_folder(spark, "raw_documents")
    table = "sortilex_" + path.rpartition("/")[2].replace("-", "_")
    english = F.col("lang").eqNullSafe("en")
    write_documents(docs.filter(english), table, "overwrite", path=path)
    write_documents(docs.filter(~english), table, "append")
    return read_documents(spark, table_name=table)


def record_runs(spark, sf_dir):
    """Record run_a, then run_b, then run_a again with another rule."""
    labelled = attach_labels(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))
    path = run_folder(spark, "metrics")
    for run_id, limit in (("run_a", 1000), ("run_b", 1000), ("run_a", 2000)):
        scored = labelled.select(
            F.col("quality").alias("label"),
            (F.col("n_chars") > limit).cast("int").alias("prediction"),
        )
        record_metrics(long_metrics(class_metrics(scored, QUALITIES)), run_id, path)
    return read_metrics(spark, path)


def write_raw_files(documents, folder):
    """Every document as a file of its own in its source's folder, beside those there.

    Hadoop's local file system starts two processes per file it creates (one chmod
    for the file, one for its checksum), so on paths that are plain files to all
    machines Python creates them. Names follow the partition, so a task that runs
    again replaces its own files.
    """
    # Creating files takes the time here, so all cores share it.
    spread = documents.select("text", "source").repartition(
        documents.sparkSession.sparkContext.defaultParallelism
    )
    jvm, conf = spread.sparkSession._jvm, spread.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(conf).makeQualified(path).toUri()
    if uri.getScheme() != "file":
        spread.write.mode("append").option("maxRecordsPerFile", 1).partitionBy("source").text(folder)
        return
    root, job = uri.getPath(), uuid.uuid4().hex

    def write(batches):
        task, n, made = TaskContext.get().partitionId(), 0, set()
        for batch in batches:
            texts, names = (batch.column(i).to_pylist() for i in (0, 1))
            for text, name in zip(texts, names, strict=True):
                below = f"{root}/source={name}"
                if below not in made:
                    os.makedirs(below, exist_ok=True)
                    made.add(below)
                with open(f"{below}/part-{task:05d}-{job}.c{n:07d}.txt", "wb") as file:
                    file.write(text + b"\n")
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    # Spark's writer takes a null text for an empty one.
    text = F.coalesce("text", F.lit("")).cast("binary")
    named = spread.select(text, _folder_name(F.col("source")))
    # The sum makes the job run; a row per task comes back.
    with shuffles_removed(spread.sparkSession):
        named.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def _folder_name(value):
    """A value as Spark's ``partitionBy`` names its folder."""
    escaped = reduce(
        lambda text, c: F.replace(text, F.lit(c), F.lit(f"%{ord(c):02X}")),
        # The percent sign first, as the others bring one.
        "%" + "".join(map(chr, range(1, 32))) + "\"#'*/:=?\\\x7f{[]^",
        value,
    )
    return F.when((value != "") & value.isNotNull(), escaped).otherwise("__HIVE_DEFAULT_PARTITION__")


def ingest_files(spark, sf_dir):
    folder = run_folder(spark, "raw_files")
    write_raw_files(_documents(spark, sf_dir), folder)
    return read_raw_files(spark, folder)


def read_raw_files(spark, folder):
    # Spark plans a task per 32 small files; whoever stores the rows pays for each task.
    files = ingest_text_files(spark, folder, path_glob="*.txt").select("folder", "content")
    return files.coalesce(8 * spark.sparkContext.defaultParallelism)


def _ingested(spark, sf_dir, settings):
    """All documents as files in the volume, taken into the store by two runs.

    Files of odd ids arrive after the first run.
    """
    documents = _documents(spark, sf_dir)
    for odd in (0, 1):
        write_raw_files(documents.filter(F.col("doc_id") % 2 == odd), settings.volume_path)
        stored = ingest_documents(spark, settings, "*.txt", buckets=STORE_BUCKETS)
    return stored


def ingest_volume_twice(spark, sf_dir):
    stored = _ingested(spark, sf_dir, _settings(spark, SOURCES))
    return stored.select("category", "text").withColumn("distinct_id", F.lit(True)).unionByName(
        # Ids come from paths, so no two documents share one.
        stored.groupBy("doc_id").agg(F.min("category").alias("category"), F.min("text").alias("text"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("category", "text", F.lit(False).alias("distinct_id"))
    )


def train_from_volume(spark, sf_dir):
    """From files to a trained model: what the training job counted on its way."""
    settings = _settings(spark, tuple(f"source={name}" for name in SOURCES))
    documents = _ingested(spark, sf_dir, settings)
    # The counts do not depend on the fit, so its steps are few.
    _, stored = train(documents, "category", settings, _params(spark, max_iter=3))
    return stored.filter("category is null").select("metric", "value")


def store_documents(spark, sf_dir):
    """All documents, then every third one changed, then the same batch once more."""
    documents = _documents(spark, sf_dir)
    store = DocumentStore(spark, run_folder(spark, "documents"), buckets=STORE_BUCKETS)
    store.put(documents)
    changed = documents.filter("doc_id % 3 = 0").withColumn("text", F.concat(F.lit("changed "), "text"))
    for _ in range(2):
        store.put(changed)
    return store.read()


# --- row-local operators -----------------------------------------------------


def domain_coverage(spark, sf_dir):
    """The domain, each class with the number of its documents."""
    known, _ = reject_unknown_category(_documents(spark, sf_dir), "source", SOURCES)
    counts = known.groupBy(F.col("source").alias("category")).agg(F.count("*").alias("n"))
    return (
        category_domain(spark, SOURCES)
        .join(counts, "category", "left")
        .select("label", "category", F.coalesce("n", F.lit(0)).alias("n_documents"))
    )


def truncate(spark, sf_dir, unit):
    cut = truncate_documents(_documents(spark, sf_dir), WORD_LIMIT, unit)
    return cut.select("doc_id", "truncated_text", "n_units", "was_truncated")


def encode(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", "source")
    return encode_category(docs, "source", SOURCES)


def decode(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", "source")
    return decode_category(encode_category(docs, "source", SOURCES), "label", SOURCES)


def reject(spark, sf_dir, side):
    """``src0`` counts as null here, so that a null category occurs."""
    docs = _documents(spark, sf_dir).select(
        "doc_id", F.expr("nullif(source, 'src0')").alias("category")
    )
    return reject_unknown_category(docs, "category", SOURCES)[side]


def split_by_text(spark, sf_dir):
    cut = truncate_documents(_documents(spark, sf_dir), WORD_LIMIT)
    return split_examples(cut, "truncated_text").select("doc_id", "split")


def split_by_id(spark, sf_dir):
    return split_examples(_documents(spark, sf_dir).select("doc_id"), ["doc_id"])


def split_by_two_keys(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", "lang", "source")
    return split_examples(docs, ["lang", "source"], "80").select("doc_id", "split")


def prepared(spark, sf_dir):
    return prepare_examples(_documents(spark, sf_dir), "source", SOURCES)


def counted(spark, sf_dir):
    return count_examples(_documents(spark, sf_dir), "source", SOURCES)


def labelled_examples(spark, sf_dir):
    labelled = attach_labels(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))
    return labelled.select("doc_id", "truncated_text", "quality", "toxic")


def labels_covered(spark, sf_dir):
    return label_coverage(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


# --- evaluation with a fixed rule --------------------------------------------


def confusion(spark, sf_dir):
    labelled = attach_labels(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))
    return confusion_matrix(
        labelled.select(
            F.col("quality").alias("label"),
            (F.col("n_chars") > 1000).cast("int").alias("prediction"),
        )
    )


def rule_metrics(spark, sf_dir, held_out):
    """Metrics of the rule "a text of at least 128 tokens is of high quality"."""
    labelled = attach_labels(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))
    if held_out:
        labelled = split_examples(labelled, "truncated_text").filter("split = 'test'")
    scored = labelled.select(
        F.col("quality").alias("label"),
        (F.col("n_units") >= WORD_LIMIT).cast("int").alias("prediction"),
    )
    return class_metrics(scored, QUALITIES)


# --- fitted models -----------------------------------------------------------

def fit_language(spark, sf_dir, **changes):
    """Held-out metrics of a language classifier fitted on the train rows."""
    examples = prepare_examples(_documents(spark, sf_dir), "lang", LANGS)
    _, metrics = fit_and_evaluate(
        examples, run_folder(spark, "examples"), _params(spark, **changes), LANGS
    )
    return metrics


def _language_model(spark, sf_dir) -> PipelineModel:
    """The language classifier of these tables."""
    examples = prepare_examples(_documents(spark, sf_dir), "lang", LANGS)
    return fit_classifier(examples.filter("split = 'train'"), _params(spark), LANGS)


def _cut_documents(spark, sf_dir):
    cut = truncate_documents(_documents(spark, sf_dir), WORD_LIMIT)
    return cut.select("doc_id", "truncated_text")


def _params(spark, **changes):
    return ClassifierParams(partitions=spark.sparkContext.defaultParallelism, **changes)


def _settings(spark, categories):
    root = run_folder(spark, "project")
    return Settings(
        catalog_name="spark_catalog",
        schema_name="default",
        registered_model_name="text_classifier",
        run_id="run_1",
        endpoint_name="text_endpoint",
        storage_root=root,
        volume_root=f"{root}/volumes",
        categories=categories,
    )


def fit_quality(spark, sf_dir):
    """Held-out metrics of a quality classifier fitted on the labelled train rows."""
    usable = with_text(_documents(spark, sf_dir))
    examples = attach_labels(usable, _table(spark, sf_dir, "labels")).select(
        "doc_id", "truncated_text", F.col("quality").alias("label")
    )
    _, metrics = fit_and_evaluate(
        split_examples(examples, "truncated_text"),
        run_folder(spark, "examples"),
        _params(spark),
        QUALITIES[:2],
    )
    return metrics


def known_answers(spark, sf_dir):
    """Each document's language name as its text: the one right answer is that name."""
    docs = _documents(spark, sf_dir).select("doc_id", "lang", F.col("lang").alias("text"))
    cut = truncate_documents(docs, WORD_LIMIT).drop("text")
    model = fit_classifier(encode_category(cut, "lang", LANGS), categories=LANGS)
    return score_batch(cut, model, LANGS).select("doc_id", "prediction", "predicted_category")


def _checked_metrics(metrics):
    """Of a fitted model's metrics what holds for any good fit, one row per class.

    ``consistent``: the ratios follow from the counts and no count exceeds another
    that bounds it. ``beats_majority``: over all classes more rows are right than
    the most frequent class has.
    """
    hits, support, predicted = F.col("true_positive"), F.col("support"), F.col("predicted")
    ratios = (
        F.col("precision").eqNullSafe(F.try_divide(hits, predicted))
        & F.col("recall").eqNullSafe(F.try_divide(hits, support))
        & F.col("f1").eqNullSafe(F.try_divide(2 * hits, support + predicted))
    )
    overall = metrics.agg((F.sum(hits) > F.max(support)).alias("beats_majority"))
    # One row beside a row per class.
    return metrics.select(
        "label",
        "category",
        "support",
        (ratios & hits.between(0, F.least(support, predicted))).alias("consistent"),
        F.lit(1).alias("one"),
    ).join(overall.withColumn("one", F.lit(1)), "one").drop("one")


def fit_language_checked(spark, sf_dir):
    return _checked_metrics(fit_language(spark, sf_dir))


def fit_quality_checked(spark, sf_dir):
    """Without ``beats_majority``: in the small tables this fit calls every text high."""
    return _checked_metrics(fit_quality(spark, sf_dir)).drop("beats_majority")


def language_support(spark, sf_dir):
    """Of the fitted model's metrics, the counts that do not depend on the fit."""
    metrics = fit_language(spark, sf_dir, max_iter=10)
    # Every test row is predicted once, so over all classes the two are equal.
    totals = metrics.rollup("category").agg(
        F.sum("support").alias("support"),
        F.when(F.grouping("category") == 1, F.sum("predicted")).alias("predicted"),
    )
    return totals.na.fill("all", ["category"])


def train_language(spark, sf_dir):
    """The whole training job: prepare, fit, save, evaluate, record, read back."""
    _, stored = train(_documents(spark, sf_dir), "lang", _settings(spark, LANGS), _params(spark))
    return _checked_run(stored)


def _checked_run(stored):
    """Every stored row; ``value`` only where it does not depend on the fit.

    ``in_range``: a ratio is null or lies within 0 and 1, a count is whole and
    not negative.
    """
    ratio = F.col("metric").isin("precision", "recall", "f1")
    fitted = ratio | F.col("metric").isin("predicted", "true_positive")
    value = F.col("value")
    whole = F.coalesce((value >= 0) & (value == F.floor(value)), F.lit(False))
    return stored.select(
        "category",
        "metric",
        "run_id",
        F.when(~fitted, value).alias("value"),
        F.when(ratio, F.coalesce(value.between(0, 1), F.lit(True))).otherwise(whole).alias("in_range"),
    )


def train_counts(spark, sf_dir):
    """What the training job counted on its way; ``source`` as the category."""
    settings = _settings(spark, SOURCES)
    # The counts do not depend on the fit, so its steps are few.
    _, stored = train(_documents(spark, sf_dir), "source", settings, _params(spark, max_iter=10))
    return stored.filter("category is null").select("metric", "value")


def _bucket_counts(cut, hashing):
    """Rows ``(doc_id, bucket, n)``: how often a document has terms of a feature.

    Local to each row: a document is hashed once as a whole, and the vector's own
    spelling ``(size,[buckets],[counts])`` is taken apart.
    """
    # Empty in place of null, which the hashing refuses; it has no term either way.
    words = F.split(F.coalesce("truncated_text", F.lit("")), " ")
    terms = cut.select("doc_id", F.array_remove(words, "").alias(hashing.getInputCol()))
    vector = F.col(hashing.getOutputCol()).cast("string")
    inner = F.regexp_extract(vector, r"\[(.*)\]", 1)
    sides = hashing.transform(terms).select("doc_id", F.split(inner, r"\],\[").alias("sides"))
    pairs = F.arrays_zip(*(F.split(F.get("sides", F.lit(k)), ",").alias(c) for k, c in enumerate(("bucket", "n"))))
    # A document without terms has two empty spellings, which are no numbers.
    return sides.select("doc_id", F.inline(pairs)).select(
        "doc_id", F.col("bucket").try_cast("long").alias("bucket"), F.col("n").try_cast("double").alias("n")
    )


def recomputed_probabilities(cut, model):
    """Rows ``(doc_id, p)``: class probabilities by a join of terms with weights.

    A second way beside the model's own: exploded term counts meet a table of the
    weights times the IDF, and the sums go through the softmax. The weights are
    bounded by the model's number of features. A document's counts stay in its task
    until they are summed, so one row per document moves and not one per term.
    """
    hashing, idf, regression = model.stages[1:]
    weights = regression.coefficientMatrix.toArray() * idf.idf.toArray()
    intercepts = regression.interceptVector.toArray().tolist()
    table = pa.table(
        {"bucket": np.arange(weights.shape[1]), **{f"w{k}": row for k, row in enumerate(weights)}}
    )
    sums = (
        _bucket_counts(cut, hashing)
        .join(cut.sparkSession.createDataFrame(table), "bucket")
        .groupBy("doc_id")
        .agg(*(F.sum(F.col("n") * F.col(f"w{k}")).alias(f"m{k}") for k in range(len(weights))))
    )
    margins = F.array(*(F.col(f"m{k}") + b for k, b in enumerate(intercepts)))
    sums = sums.select("doc_id", margins.alias("m"))
    powers = F.transform("m", lambda x: F.exp(x - F.array_max("m")))
    sums = sums.select("doc_id", powers.alias("e"))
    total = F.aggregate("e", F.lit(0.0), lambda a, b: a + b)
    return sums.select("doc_id", F.transform("e", lambda x: x / total).alias("p"))


def checked_scores(scored, cut, model, names):
    """One row per document: whether its score is there once, well formed and right.

    ``right``: the confidence is the probability that ``recomputed_probabilities``
    finds for the predicted class, and no class has a higher one. A document
    without text must have null scores.
    """
    found = scored.groupBy("doc_id").agg(
        F.count("*").alias("n"),
        *(F.min(c).alias(c) for c in ("prediction", "predicted_category", "confidence")),
    )
    texts = cut.select("doc_id", (F.length("truncated_text") > 0).alias("scorable"))
    every = texts.join(found, "doc_id", "left").join(
        recomputed_probabilities(cut, model), "doc_id", "left"
    )
    scorable = F.coalesce("scorable", F.lit(False))
    unscored = F.col("prediction").isNull() & F.col("confidence").isNull()
    name = F.get(F.array(*map(F.lit, names)), F.col("prediction"))
    own = F.get("p", F.col("prediction"))

    def holds(test):
        return F.when(scorable, F.coalesce(test, F.lit(False))).otherwise(unscored)

    near = F.abs(own - F.col("confidence")) <= 1e-9
    return every.select(
        "doc_id",
        F.coalesce(F.col("n") == 1, F.lit(False)).alias("scored_once"),
        holds(name == F.col("predicted_category")).alias("named"),
        holds(F.col("confidence").between(1 / len(names) - 1e-9, 1)).alias("bounded"),
        holds(near & (own >= F.array_max("p") - 1e-9)).alias("right"),
    )


def score_batch_checked(spark, sf_dir):
    model = _language_model(spark, sf_dir)
    scored = score_documents(spark, sf_dir, model)
    return checked_scores(scored, _cut_documents(spark, sf_dir), model, LANGS)


def score_stream_checked(spark, sf_dir):
    model = _language_model(spark, sf_dir)
    scored = score_arriving(spark, sf_dir, model)
    return checked_scores(scored, _cut_documents(spark, sf_dir), model, LANGS)


def score_by_name(spark, sf_dir):
    """Train a run, find its model by the settings alone, store the scores of an endpoint."""
    settings = _settings(spark, LANGS)
    model, _ = train(_documents(spark, sf_dir), "lang", settings, _params(spark))
    scored = score_registered(spark, sf_dir, settings)
    return checked_scores(scored, _cut_documents(spark, sf_dir), model, LANGS)


def score_registered(spark, sf_dir, settings):
    endpoint = settings.prod_serving_endpoint_name
    model = load_registered(settings)
    stored = score_to_endpoint(_documents(spark, sf_dir), model, settings, endpoint)
    return stored.select("doc_id", "prediction", "predicted_category", "confidence")


def score_documents(spark, sf_dir, model):
    scored = score_table(_documents(spark, sf_dir), model, _settings(spark, LANGS))
    return scored.select("doc_id", "prediction", "predicted_category", "confidence")


def score_arriving(spark, sf_dir, model):
    settings = _settings(spark, LANGS)
    arriving = _arriving(spark, sf_dir, "documents")
    endpoint = settings.stg_serving_endpoint_name
    serve(arriving, model, settings, endpoint).awaitTermination()
    scored = spark.read.parquet(settings.scores_path(endpoint))
    return scored.select("doc_id", "prediction", "predicted_category", "confidence")


def _same_scores(left, right):
    """One row per document: whether both sides scored it once and alike."""
    score = F.struct("prediction", "predicted_category", "confidence")
    sides = left.select("doc_id", F.lit(1).alias("l"), score.alias("s")).unionByName(
        right.select("doc_id", F.lit(0).alias("l"), score.alias("s"))
    )
    return sides.groupBy("doc_id").agg(
        ((F.sum("l") == 1) & (F.count("*") == 2) & (F.min("s") == F.max("s"))).alias("same")
    )


def stream_equals_batch(spark, sf_dir):
    return _stream_against_batch(spark, sf_dir, _language_model(spark, sf_dir))


def _stream_against_batch(spark, sf_dir, model):
    return _same_scores(score_arriving(spark, sf_dir, model), score_documents(spark, sf_dir, model))


def _unsaved_model(spark, sf_dir):
    examples = prepare_examples(_documents(spark, sf_dir), "lang", LANGS)
    return fit_unsaved(examples.filter("split = 'train'"), _params(spark), LANGS)


def reloaded_model_scores(spark, sf_dir):
    return _saved_against_unsaved(spark, sf_dir, _unsaved_model(spark, sf_dir))


def _saved_against_unsaved(spark, sf_dir, model):
    """The model as it came from the fit against the one read back from its folder."""
    path = run_folder(spark, "model")
    model.write().save(path)
    cut = _cut_documents(spark, sf_dir)
    before, after = run_folder(spark, "scores"), load_classifier(path)
    score_batch(cut, model, LANGS).write.parquet(before)
    return _same_scores(spark.read.parquet(before), score_batch(cut, after, LANGS))


def score_promoted(spark, sf_dir):
    """A stream that scores even ids with version 1 and, after a promotion, odd ones with 2.

    One row per document: its version, and whether the batch scores of that version,
    loaded by its number, are the same.
    """
    settings, documents = _settings(spark, LANGS), _documents(spark, sf_dir)
    versions, endpoint = ModelVersions(spark, settings), settings.prod_serving_endpoint_name
    examples = prepare_examples(documents, "lang", LANGS).filter("split = 'train'")
    for bits in (8, 10):
        # Any two models that differ will do.
        params = _params(spark, num_features=1 << bits, max_iter=3)
        versions.register(fit_classifier(examples, params, LANGS))
    arriving = run_folder(spark, "arriving")
    wanted = None
    for odd in (0, 1):
        half = documents.filter(F.col("doc_id") % 2 == odd)
        half.write.mode("append").parquet(arriving)
        versions.promote(endpoint, odd + 1)
        stream = stream_documents(spark, arriving, documents.schema)
        serve_promoted(stream, settings, endpoint).awaitTermination()
        scored = score_table(half, load_registered(settings, odd + 1, spark), settings)
        scored = scored.withColumn("model_version", F.lit(odd + 1))
        wanted = scored if wanted is None else wanted.unionByName(scored)
    got = read_promoted(spark, settings, endpoint)
    columns = ("doc_id", "model_version", "prediction", "predicted_category", "confidence")
    got, wanted = got.select(*columns), wanted.select(*columns)
    same = _same_scores(got.drop("model_version"), wanted.drop("model_version"))
    return got.select("doc_id", "model_version").join(same, "doc_id")


def _score_embeddings(df):
    """A user's model: a class scores the greatest of the dimensions dealt to it in turn."""

    def make_predict_fn():
        def predict(embedding):
            dealt = [embedding[:, k :: len(SOURCES)].max(axis=1) for k in range(len(SOURCES))]
            return np.stack(dealt, axis=1).astype("float64")

        return predict

    scored = score_batch_udf(
        df, make_predict_fn, ["embedding"], SOURCES, input_tensor_shapes=[[64]]
    )
    return scored.drop("embedding")


def score_with_user_model(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return _score_embeddings(vectors)


def _length_model():
    """A text model of the caller's: a class scores how far the length is from its own."""

    def predict(texts):
        lengths = np.array([len(t) for t in texts])[:, None]
        return -((lengths - np.arange(len(SOURCES)) * 100) ** 2).astype("float64")

    return predict


def score_by_length(spark, sf_dir):
    cut = truncate_documents(_documents(spark, sf_dir), 1000, "char")
    scored = score_texts_by_length(cut.select("doc_id", "truncated_text"), _length_model, categories=SOURCES)
    return scored.drop("truncated_text")


def stream_with_user_model(spark, sf_dir):
    arriving = _arriving(spark, sf_dir, "embeddings")
    out, checkpoint = run_folder(spark, "scores"), run_folder(spark, "progress")
    score_stream(
        arriving.select("vec_id", "embedding"), _score_embeddings, out, checkpoint
    ).awaitTermination()
    return spark.read.parquet(out)


def entry(spark: SparkSession) -> DataFrame:
    """Labelled documents, truncated and split; fit on train, metrics on test."""
    return fit_quality(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query; each runs over whole tables."""
    extra = {"pipeline": corpus_pipeline.run, **llm_queries()} if corpus_pipeline else {}
    return extra | {
        "read_documents": read_all,
        "write_documents": write_and_read,
        "record_metrics": record_runs,
        "ingest_text_files": ingest_files,
        "ingest_volume": ingest_volume_twice,
        "document_store": store_documents,
        "category_domain": domain_coverage,
        "truncate_tokens": partial(truncate, unit="token"),
        "truncate_chars": partial(truncate, unit="char"),
        "encode_category": encode,
        "decode_category": decode,
        "reject_unknown_category_valid": partial(reject, side=0),
        "reject_unknown_category_rejected": partial(reject, side=1),
        "split_examples": split_by_text,
        "split_examples_by_id": split_by_id,
        "split_examples_by_two_keys": split_by_two_keys,
        "prepare_examples": prepared,
        "count_examples": counted,
        "labelled_examples": labelled_examples,
        "label_coverage": labels_covered,
        "confusion_matrix": confusion,
        "class_metrics": partial(rule_metrics, held_out=False),
        "held_out_class_metrics": partial(rule_metrics, held_out=True),
        "fit_classifier": fit_language_checked,
        "fit_classifier_support": language_support,
        "fit_classifier_known_answers": known_answers,
        "fit_classifier_quality": fit_quality_checked,
        "train": train_language,
        "train_counts": train_counts,
        "train_from_volume": train_from_volume,
        "score_batch": score_batch_checked,
        "score_batch_by_name": score_by_name,
        "score_batch_reloaded_model": reloaded_model_scores,
        "score_batch_udf": score_with_user_model,
        "score_texts_by_length": score_by_length,
        "score_stream": score_stream_checked,
        "score_stream_equals_batch": stream_equals_batch,
        "score_stream_promoted": score_promoted,
        "score_stream_udf": stream_with_user_model,
    }


# --- operators without what prepares and checks them --------------------------


def _ingest_alone(spark, sf_dir):
    folder = run_folder(spark, "raw_files")
    write_raw_files(_documents(spark, sf_dir), folder)
    return lambda: read_raw_files(spark, folder)


def _with_model(run, fit=_language_model):
    """``run`` with a model that is fitted beforehand."""

    def prepare(spark, sf_dir):
        model = fit(spark, sf_dir)
        return lambda: run(spark, sf_dir, model)

    return prepare


def _registered_alone(spark, sf_dir):
    settings = _settings(spark, LANGS)
    train(_documents(spark, sf_dir), "lang", settings, _params(spark))
    return lambda: score_registered(spark, sf_dir, settings)


def prepared_operators() -> dict[str, Callable[[SparkSession, str], Callable[[], DataFrame]]]:
    """For the bench: the queries that need files or a model, or compare scores.

    Each call prepares and returns the operator alone, so a time says nothing of the
    files' making, the fit or the check.
    """
    return {
        "ingest_text_files": _ingest_alone,
        "score_batch": _with_model(score_documents),
        "score_batch_by_name": _registered_alone,
        "score_batch_reloaded_model": _with_model(_saved_against_unsaved, _unsaved_model),
        "score_stream": _with_model(score_arriving),
        "score_stream_equals_batch": _with_model(_stream_against_batch),
    }


# --- the same in SQL ---------------------------------------------------------

_SOURCE_LIST = ", ".join(f"'{name}'" for name in SOURCES)
_SOURCE_ROWS = ", ".join(f"({i}, '{name}')" for i, name in enumerate(SOURCES))
_LANG_ROWS = ", ".join(f"({i}, '{name}')" for i, name in enumerate(LANGS))
_QUALITY_ROWS = ", ".join(f"({i}, '{name}')" for i, name in enumerate(QUALITIES))
_TOKENS = r"regexp_extract_all(text, '([^ \t\n\r\f]+)', 1)"
_FIRST_TOKENS = f"array_to_string({_TOKENS}[1:128], ' ')"
_TEXT_SPLIT = f"case when substring(md5({_FIRST_TOKENS}), 1, 2) < 'cd' then 'train' else 'test' end"
_METRICS = """
    select v.label::int as label, v.category,
        (select count(*) from s where s.label = v.label) as support,
        (select count(*) from s where s.prediction = v.label) as predicted,
        (select count(*) from s where s.label = v.label and s.prediction = v.label) as true_positive
    from (values {rows}) v(label, category)"""
_RATIOS = """true_positive::double / nullif(predicted, 0) as precision,
        true_positive::double / nullif(support, 0) as recall,
        (2.0::double * true_positive) / nullif(support + predicted, 0) as f1"""


def _metrics_sql(where: str) -> str:
    return rf"""
        with t as (
            select quality as label, len({_TOKENS}) as n_tokens, {_TEXT_SPLIT} as split
            from documents join labels using (doc_id)
        ), s as (select label, (n_tokens >= 128)::int as prediction from t {where}),
        m as ({_METRICS.format(rows=_QUALITY_ROWS)})
        select *, {_RATIOS} from m"""


def _run_sql(run_id: str, limit: int) -> str:
    values = ", ".join(
        f"('{name}', {name}::double)"
        for name in ("support", "predicted", "true_positive", "precision", "recall", "f1")
    )
    return f"""
        select category, metric, value, '{run_id}' as run_id from (
            with s as (
                select quality as label, (n_chars > {limit})::int as prediction
                from documents join labels using (doc_id)
            ), m as ({_METRICS.format(rows=_QUALITY_ROWS)}),
            r as (select *, {_RATIOS} from m)
            select category, metric, value from r, lateral (values {values}) u(metric, value)
        )"""


def oracle_sql() -> dict[str, str]:
    """SQL for each query; of fitted models, for what holds whatever the fit."""
    same_documents = "select doc_id, true as same from documents"
    sound_scores = """
        select doc_id, true as scored_once, true as named, true as bounded, true as "right"
        from documents"""
    language_tests = f"""
        select lang as category from documents
        where {_TEXT_SPLIT} = 'test' and len({_TOKENS}) > 0"""
    quality_tests = f"""
        select case quality when 0 then 'low' else 'high' end as category
        from documents join labels using (doc_id)
        where {_TEXT_SPLIT} = 'test' and len({_TOKENS}) > 0"""

    def sound_metrics(tests, rows, more=""):
        return f"""
            with t as ({tests})
            select v.label::int as label, v.category,
                (select count(*) from t where t.category = v.category) as support,
                true as consistent {more}
            from (values {rows}) v(label, category)"""

    counts = f"""
        with t as (
            select source in ({_SOURCE_LIST}) as known, len({_TOKENS}) > 0 as has_text,
                {_TEXT_SPLIT} as split
            from documents
        )
        select count(*) as documents,
            count(*) filter (where not known) as unknown_category,
            count(*) filter (where known and not has_text) as no_text,
            count(*) filter (where known and has_text and split = 'train') as train,
            count(*) filter (where known and has_text and split = 'test') as test
        from t"""
    no_row_left_out = """
        union all select 'unscored', 0.0::double union all select 'out_of_domain', 0.0::double"""
    user_model = f"""
        with x as (
            select vec_id, unnest(embedding) as value, unnest(range(64)) % 9 as k from embeddings
        ), c as (
            select vec_id, k, max(value) as score from x group by vec_id, k
        ), b as (
            select vec_id, max(score) as best from c group by vec_id
        ), e as (
            select b.vec_id, b.best, min(c.k)::int as prediction
            from b join c on b.vec_id = c.vec_id and b.best = c.score group by b.vec_id, b.best
        )
        select vec_id, prediction, 'src' || prediction as predicted_category,
            best::double as confidence
        from e"""
    extra = llm_sql() if corpus_pipeline else {}
    return extra | {
        "read_documents": "select * from documents",
        "write_documents": "select * from documents",
        "record_metrics": f"{_run_sql('run_a', 2000)} union all {_run_sql('run_b', 1000)}",
        "ingest_text_files": "select 'source=' || source as folder, text || chr(10) as content "
        "from documents",
        "ingest_volume": "select 'source=' || source as category, text || chr(10) as text, "
        "true as distinct_id from documents",
        "document_store": """
            select doc_id, case when doc_id % 3 = 0 then 'changed ' || text else text end as text,
                lang, source, n_chars
            from documents""",
        "score_stream_promoted": """
            select doc_id, (doc_id % 2 + 1)::int as model_version, true as same from documents""",
        "category_domain": f"""
            select v.label::int as label, v.category, count(doc_id) as n_documents
            from (values {_SOURCE_ROWS}) v(label, category) left join documents on source = category
            group by all""",
        "truncate_tokens": f"""
            select doc_id, {_FIRST_TOKENS} as truncated_text, len({_TOKENS})::int as n_units,
                len({_TOKENS}) > 128 as was_truncated
            from documents""",
        "truncate_chars": """
            select doc_id, substring(text, 1, 128) as truncated_text, length(text)::int as n_units,
                length(text) > 128 as was_truncated
            from documents""",
        "encode_category": f"""
            select doc_id, source, v.label::int as label
            from documents left join (values {_SOURCE_ROWS}) v(label, category)
                on source = category""",
        "decode_category": f"""
            select doc_id, source, v.label::int as label, v.category
            from documents left join (values {_SOURCE_ROWS}) v(label, category)
                on source = category""",
        "reject_unknown_category_valid": f"""
            select doc_id, category from (
                select doc_id, nullif(source, 'src0') as category from documents)
            where category in ({_SOURCE_LIST})""",
        "reject_unknown_category_rejected": f"""
            select doc_id, category from (
                select doc_id, nullif(source, 'src0') as category from documents)
            where category is null or category not in ({_SOURCE_LIST})""",
        "split_examples": f"select doc_id, {_TEXT_SPLIT} as split from documents",
        "split_examples_by_id": """
            select doc_id, case when substring(md5(doc_id::varchar), 1, 2) < 'cd'
                then 'train' else 'test' end as split
            from documents""",
        "split_examples_by_two_keys": """
            select doc_id, case when substring(md5(md5(lang) || md5(source)), 1, 2) < '80'
                then 'train' else 'test' end as split
            from documents""",
        "prepare_examples": f"""
            select doc_id, {_FIRST_TOKENS} as truncated_text, v.label::int as label,
                {_TEXT_SPLIT} as split
            from documents join (values {_SOURCE_ROWS}) v(label, category) on source = category
            where len({_TOKENS}) > 0""",
        "count_examples": counts,
        "train_from_volume": f"with c as ({counts}) "
        + " union all ".join(
            f"select '{name}' as metric, {name}::double as value from c"
            for name in ("documents", "unknown_category", "no_text", "train", "test")
        )
        + no_row_left_out,
        "train_counts": f"with c as ({counts}) "
        + " union all ".join(
            f"select '{name}' as metric, {name}::double as value from c"
            for name in ("documents", "unknown_category", "no_text", "train", "test")
        )
        + no_row_left_out,
        "labelled_examples": f"""
            select doc_id, {_FIRST_TOKENS} as truncated_text, quality, toxic
            from documents join labels using (doc_id)""",
        "confusion_matrix": """
            select quality as label, (n_chars > 1000)::int as prediction, count(*) as n
            from documents join labels using (doc_id) group by all""",
        "class_metrics": _metrics_sql(""),
        "held_out_class_metrics": _metrics_sql("where split = 'test'"),
        "fit_classifier_support": f"""
            with t as (
                select lang from documents where {_TEXT_SPLIT} = 'test' and len({_TOKENS}) > 0
            )
            select category, (select count(*) from t where lang = category) as support,
                null::bigint as predicted
            from (values {_LANG_ROWS}) v(label, category)
            union all select 'all', count(*), count(*) from t""",
        "fit_classifier_known_answers": f"""
            select doc_id, v.label::int as prediction, lang as predicted_category
            from documents join (values {_LANG_ROWS}) v(label, category) on lang = category""",
        "fit_classifier": sound_metrics(
            language_tests, _LANG_ROWS, ", true as beats_majority"
        ),
        "fit_classifier_quality": sound_metrics(
            quality_tests, ", ".join(f"({i}, '{name}')" for i, name in enumerate(QUALITIES[:2]))
        ),
        "train": f"""
            with t as ({language_tests}), k as (
                select lang in (select category from (values {_LANG_ROWS}) v(label, category)) as known,
                    len({_TOKENS}) > 0 as has_text, {_TEXT_SPLIT} as split
                from documents
            ), c as (
                select count(*) as documents,
                    count(*) filter (where not known) as unknown_category,
                    count(*) filter (where known and not has_text) as no_text,
                    count(*) filter (where known and has_text and split = 'train') as train,
                    count(*) filter (where known and has_text and split = 'test') as test
                from k
            ), r as (
                select v.category, m.metric, case when m.metric = 'support' then
                    (select count(*) from t where t.category = v.category)::double end as value
                from (values {_LANG_ROWS}) v(label, category), (values ('support'), ('predicted'),
                    ('true_positive'), ('precision'), ('recall'), ('f1')) m(metric)
                union all select null, metric, n::double
                from (unpivot c on documents, unknown_category, no_text, train, test
                    into name metric value n)
                union all select null, metric, 0.0::double
                from (values ('unscored'), ('out_of_domain')) m(metric)
            )
            select category, metric, value, 'run_1' as run_id, true as in_range from r""",
        "label_coverage": """
            select (select count(*) from documents) as documents,
                (select count(*) from labels) as labels,
                (select count(*) from documents d
                    where not exists (from labels l where l.doc_id = d.doc_id)) as unlabelled_documents,
                (select count(*) from labels l
                    where not exists (from documents d where d.doc_id = l.doc_id)) as orphan_labels""",
        "score_batch": sound_scores,
        "score_batch_by_name": sound_scores,
        "score_stream": sound_scores,
        "score_batch_reloaded_model": same_documents,
        "score_batch_udf": user_model,
        "score_stream_equals_batch": same_documents,
        "score_stream_udf": user_model,
        "score_texts_by_length": """
            with l as (
                select doc_id, length(substring(text, 1, 1000)) as n from documents where text <> ''
            ), s as (
                select doc_id, k, -((n - 100 * k) * (n - 100 * k))::double as score
                from l, range(9) r(k)
            ), b as (
                select doc_id, max(score) as best from s group by doc_id
            )
            select b.doc_id, min(s.k)::int as prediction, 'src' || min(s.k) as predicted_category,
                b.best as confidence
            from b join s on b.doc_id = s.doc_id and s.score = b.best group by b.doc_id, b.best""",
    }
