"""Turn documents into labelled, split examples.

``attach_labels`` serves tables that keep labels apart from documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import encode_category, reject_unknown_category, split_examples, truncate_documents
from ..settings import CATEGORY_LIST, MAX_LENGTH, SPLIT_THRESHOLD


def _text_test(unit: str):
    return X.has_token if unit == "token" else X.has_text


def with_text(documents: DataFrame, unit: str = "token", text_col: str = "text") -> DataFrame:
    """The documents with at least one unit of text.

    Tests the given text, not the cut one: Spark moves a filter below the cut,
    and would then cut each text twice.
    """
    return documents.filter(_text_test(unit)(F.col(text_col)))


def prepare_examples(
    documents: DataFrame,
    category_col: str,
    categories=CATEGORY_LIST,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_length: int = MAX_LENGTH,
    unit: str = "token",
    threshold: str = SPLIT_THRESHOLD,
) -> DataFrame:
    """Rows ``(id, truncated_text, label, split)`` of the usable documents.

    Usable means: some text, and a category of the domain. ``count_examples``
    counts what is not. Local to each row; the whole text is not carried on.
    """
    known, _ = reject_unknown_category(documents, category_col, categories)
    cut = truncate_documents(with_text(known, unit, text_col), max_length, unit, text_col)
    labelled = encode_category(
        cut.select(id_col, category_col, "truncated_text"), category_col, categories
    )
    return split_examples(labelled.drop(category_col), "truncated_text", threshold)


def intake_counts(category_col: str, categories) -> list[Column]:
    """Aggregates over documents: all, and those of an unknown category."""
    known = X.is_known_category(F.col(category_col), categories)
    return [
        F.count(F.lit(1)).alias("documents"),
        F.count_if(~known).alias("unknown_category"),
    ]


def no_text_count(category_col: str, categories, text_col: str, unit: str) -> Column:
    """Aggregate over documents: those of a known category without text."""
    known = X.is_known_category(F.col(category_col), categories)
    return F.count_if(known & ~_text_test(unit)(F.col(text_col))).alias("no_text")


def split_counts() -> list[Column]:
    """Aggregates over examples: train and test rows."""
    return [F.count_if(F.col("split") == mark).alias(mark) for mark in ("train", "test")]


def count_examples(
    documents: DataFrame,
    category_col: str,
    categories=CATEGORY_LIST,
    text_col: str = "text",
    max_length: int = MAX_LENGTH,
    unit: str = "token",
    threshold: str = SPLIT_THRESHOLD,
) -> DataFrame:
    """One row: documents, those set aside by reason, and train and test counts.

    The reasons do not overlap: an unknown category counts first. One scan, and
    each task sends one row.
    """
    known = X.is_known_category(F.col(category_col), categories)
    some_text = _text_test(unit)(F.col(text_col))
    # What is not usable is neither cut nor marked: a null text has a null split.
    usable = documents.withColumn(text_col, F.when(known & some_text, F.col(text_col)))
    cut = truncate_documents(usable, max_length, unit, text_col)
    return split_examples(cut, "truncated_text", threshold).agg(
        *intake_counts(category_col, categories),
        no_text_count(category_col, categories, text_col, unit),
        *split_counts(),
    )


def attach_labels(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text_col: str = "text",
    max_length: int = MAX_LENGTH,
    unit: str = "token",
) -> DataFrame:
    """Documents joined to a label table on ``key``, text already truncated.

    The cut comes before the join, so a shuffle moves at most ``max_length``
    units per document in place of whole texts. Neither side is broadcast by
    hint: Spark decides from their sizes, and AQE splits a key that dominates.

    Documents without a label and labels without a document drop out;
    ``label_coverage`` counts them. A key that repeats on either side gives a row
    per pair.
    """
    cut = truncate_documents(documents, max_length, unit, text_col).drop(text_col)
    return cut.join(labels, key)


def label_coverage(documents: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row: documents, labels, and those of either without a partner.

    Reads the keys alone and counts them per key before they move, so a key that
    repeats is one row per task. A null key has no partner.
    """
    one, none = F.lit(1).alias, F.lit(0).alias
    sides = documents.select(key, one("d"), none("l")).unionByName(
        labels.select(key, none("d"), one("l"))
    )
    per_key = sides.groupBy(key).agg(F.sum("d").alias("d"), F.sum("l").alias("l"))
    alone = F.col(key).isNull()

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return per_key.agg(
        total(F.col("d")).alias("documents"),
        total(F.col("l")).alias("labels"),
        total(F.when(alone | (F.col("l") == 0), F.col("d"))).alias("unlabelled_documents"),
        total(F.when(alone | (F.col("d") == 0), F.col("l"))).alias("orphan_labels"),
    )
