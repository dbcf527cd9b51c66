"""The closed category domain and what follows from it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import category_name, is_known_category
from ..settings import CATEGORY_LIST, check_categories


def category_domain(spark: SparkSession, categories=CATEGORY_LIST) -> DataFrame:
    """The domain as rows ``(label int, category string)``; label is the position.

    One row of a range per name, so that Spark knows the number of rows and
    picks a join by their size.
    """
    names = check_categories(categories)
    listed = F.from_json(F.lit(json.dumps(names)), "array<string>")
    label = F.col("id").cast("int")
    return spark.range(0, len(names), 1, 1).select(
        label.alias("label"), F.get(listed, label).alias("category")
    )


def encode_category(
    df: DataFrame, col: str, categories=CATEGORY_LIST, label_col: str = "label"
) -> DataFrame:
    """Add the class id of the name in ``col``; null for an unknown or null name.

    No row is lost. Spark sends a small domain to every task; one beyond its
    broadcast threshold is shuffled on the name, and AQE splits a name that
    dominates.
    """
    if label_col in df.columns:
        raise ValueError(f"the input already has a column {label_col!r}")
    names = check_categories(categories)
    key = "__domain_category"
    domain = category_domain(df.sparkSession, names).select(
        F.col("label").alias(label_col), F.col("category").alias(key)
    )
    return df.join(domain, F.col(col) == F.col(key), "left").drop(key)


def decode_category(
    df: DataFrame, label_col: str, categories=CATEGORY_LIST, category_col: str = "category"
) -> DataFrame:
    """Add the name of the class id in ``label_col``; null outside the domain."""
    if category_col in df.columns:
        raise ValueError(f"the input already has a column {category_col!r}")
    return df.withColumn(category_col, category_name(F.col(label_col), categories))


def reject_unknown_category(
    df: DataFrame, col: str, categories=CATEGORY_LIST
) -> tuple[DataFrame, DataFrame]:
    """Split the rows into ``(valid, rejected)``; a null category is rejected.

    The domain is a short list, so this is a filter and not a join: the valid
    side reaches a Parquet scan as a pushed ``IN``.
    """
    names = check_categories(categories)
    return df.filter(F.col(col).isin(*names)), df.filter(~is_known_category(F.col(col), names))
