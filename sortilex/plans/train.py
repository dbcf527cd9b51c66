"""Prepare, fit, evaluate and record one run."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import (
    ClassifierParams,
    class_metrics,
    confusion_matrix,
    count_terms,
    fit_classifier,
    long_metrics,
    matrix_counts,
    matrix_metrics,
    score_batch,
)
from ..operators.classifier import COUNTS_COL
from ..settings import Settings
from ..sources import read_metrics, record_metrics
from .examples import intake_counts, no_text_count, prepare_examples, split_counts


def fit_and_score(
    examples: DataFrame,
    examples_path: str,
    params: ClassifierParams,
    categories,
    model_path: str | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """The model fitted on the train rows, and the scored test rows.

    The examples are written once, by split and with their hashed terms, where the
    scan has them: the fit then reads the hashed terms of train files alone and the
    evaluation only test files, nothing is shuffled or cached, and a lost executor
    repeats a scan in place of the preparation.
    """
    spark = examples.sparkSession
    counted = count_terms(examples, params)
    counted.write.mode("overwrite").partitionBy("split").parquet(examples_path)
    stored = spark.read.parquet(examples_path)
    model = fit_classifier(
        stored.filter(F.col("split") == "train"), params, categories, path=model_path
    )
    test = stored.filter(F.col("split") == "test").drop(COUNTS_COL)
    return model, score_batch(test, model, categories)


def fit_and_evaluate(
    examples: DataFrame,
    examples_path: str,
    params: ClassifierParams,
    categories,
    model_path: str | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """The model of ``fit_and_score``, and its metrics on the test rows."""
    model, scored = fit_and_score(examples, examples_path, params, categories, model_path)
    return model, class_metrics(scored, categories)


def train(
    documents: DataFrame,
    category_col: str,
    settings: Settings,
    params: ClassifierParams | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[PipelineModel, DataFrame]:
    """Train on a document table as ``settings`` say; save model and metrics.

    Returns the model and this run's stored rows ``(category, metric, value,
    run_id)``. Rows without a category count documents: all, those set aside by
    reason, train and test; and test rows that the model left unscored or whose
    label or prediction no class of the domain has. The documents are read once: they
    are counted as the examples are written.
    """
    spark = documents.sparkSession
    params = params or ClassifierParams(unit=settings.unit)
    if params.unit != settings.unit:
        raise ValueError(f"the text is cut by {settings.unit}, the model reads {params.unit}s")
    intake_aggregates = (
        *intake_counts(category_col, settings.categories),
        no_text_count(category_col, settings.categories, text_col, settings.unit),
    )
    intake, kept = Observation("intake"), Observation("kept")
    examples = prepare_examples(
        documents.observe(intake, *intake_aggregates),
        category_col,
        settings.categories,
        id_col,
        text_col,
        settings.max_length,
        settings.unit,
        settings.split_threshold,
    ).observe(kept, *split_counts())
    model, scored = fit_and_score(
        examples,
        settings.examples_path,
        params,
        settings.categories,
        settings.model_path,
    )
    counts = {**intake.get, **kept.get}
    if not _adds_up(counts):
        # Tasks that ran again may have been counted twice; a scan of its own is exact.
        stored = spark.read.parquet(settings.examples_path)
        counts = {
            **documents.agg(*intake_aggregates).first().asDict(),
            **stored.agg(*split_counts()).first().asDict(),
        }
    if not _adds_up(counts):
        raise RuntimeError(f"rows were lost, or the table changed between the passes: {counts}")
    # One row per pair of classes, so the test rows are scored once for all that follows.
    matrix = confusion_matrix(scored)
    matrix = spark.createDataFrame(matrix.collect(), matrix.schema)
    left_out = matrix_counts(matrix, settings.categories).first().asDict()
    if left_out.pop("evaluated") != counts["test"]:
        raise RuntimeError(f"{counts['test']} test rows were stored, but not as many were scored")
    rows = [(None, name, float(count)) for name, count in {**counts, **left_out}.items()]
    rows = spark.createDataFrame(rows, "category string, metric string, value double")
    metrics = long_metrics(matrix_metrics(matrix, settings.categories))
    record_metrics(metrics.unionByName(rows), settings.run_id, settings.metrics_path)
    results = read_metrics(spark, settings.metrics_path)
    return model, results.filter(F.col("run_id") == settings.run_id)


def _adds_up(n: dict) -> bool:
    return sum(n[name] for name in ("unknown_category", "no_text", "train", "test")) == n["documents"]
