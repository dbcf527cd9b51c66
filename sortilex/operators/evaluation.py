"""Evaluation results of scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import category_name
from ..settings import CATEGORY_LIST, check_categories
from .category import category_domain


def confusion_matrix(
    scored: DataFrame, label_col: str = "label", prediction_col: str = "prediction"
) -> DataFrame:
    """Rows ``(label, prediction, n)``; nulls form groups of their own.

    Each task sends at most one row per pair, so a class that dominates costs
    no more than another.
    """
    return scored.groupBy(
        F.col(label_col).cast("int").alias("label"),
        F.col(prediction_col).cast("int").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(
    scored: DataFrame,
    categories=CATEGORY_LIST,
    label_col: str = "label",
    prediction_col: str = "prediction",
) -> DataFrame:
    """Precision, recall and F1 of every class of the domain, with their counts.

    A class never predicted has null precision, one without examples null
    recall, one with neither null F1. A prediction on a row whose label is null
    or outside the domain counts against its class's precision. Works from the
    confusion matrix, so the scored rows are read once and none is duplicated;
    ``matrix_counts`` says how many rows no class counts.
    """
    return matrix_metrics(confusion_matrix(scored, label_col, prediction_col), categories)


def matrix_counts(matrix: DataFrame, categories=CATEGORY_LIST) -> DataFrame:
    """One row: ``evaluated`` rows, those ``unscored``, and those ``out_of_domain``.

    Unscored: the prediction is null. Out of the domain: the label is null or no
    class id, or the prediction is one that no class has. A row can be both.
    """
    names = check_categories(categories)

    def known(column):
        return F.coalesce(F.col(column).between(0, len(names) - 1), F.lit(False))

    foreign = ~known("label") | (F.col("prediction").isNotNull() & ~known("prediction"))

    def total(test):
        return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))

    return matrix.agg(
        total(F.lit(True)).alias("evaluated"),
        total(F.col("prediction").isNull()).alias("unscored"),
        total(foreign).alias("out_of_domain"),
    )


def matrix_metrics(matrix: DataFrame, categories=CATEGORY_LIST) -> DataFrame:
    """The class metrics of a confusion matrix ``(label, prediction, n)``."""
    names = check_categories(categories)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    none = F.lit(0).cast("bigint")
    as_label = F.struct(
        F.col("label").alias("label"),
        F.col("n").alias("support"),
        none.alias("predicted"),
        hit.cast("bigint").alias("true_positive"),
    )
    as_prediction = F.struct(
        F.col("prediction").alias("label"),
        none.alias("support"),
        F.col("n").alias("predicted"),
        none.alias("true_positive"),
    )
    sides = matrix.select(F.inline(F.array(as_label, as_prediction)))
    # A zero row per class keeps every class without a join.
    zeros = category_domain(matrix.sparkSession, names).select(
        "label",
        none.alias("support"),
        none.alias("predicted"),
        none.alias("true_positive"),
    )
    counts = (
        sides.filter(F.col("label").between(0, len(names) - 1))
        .unionByName(zeros)
        .groupBy("label")
        .agg(*(F.sum(c).alias(c) for c in ("support", "predicted", "true_positive")))
    )
    hits = F.col("true_positive").cast("double")
    return counts.select(
        "label",
        category_name(F.col("label"), names).alias("category"),
        "support",
        "predicted",
        "true_positive",
        F.try_divide(hits, F.col("predicted")).alias("precision"),
        F.try_divide(hits, F.col("support")).alias("recall"),
        F.try_divide(2 * hits, F.col("support") + F.col("predicted")).alias("f1"),
    )


def long_metrics(metrics: DataFrame) -> DataFrame:
    """Class metrics as rows ``(category, metric, value)``, the stored form."""
    names = ("support", "predicted", "true_positive", "precision", "recall", "f1")
    wide = metrics.select("category", *(F.col(name).cast("double") for name in names))
    return wide.unpivot("category", list(names), "metric", "value")
