"""Deterministic train and test marks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import split_mark
from ..settings import SPLIT_THRESHOLD


def split_examples(
    df: DataFrame, key_cols, threshold: str = SPLIT_THRESHOLD, split_col: str = "split"
) -> DataFrame:
    """Add ``train`` or ``test`` by the md5 of the key columns.

    Key on the truncated text, not on an id, so that copies of a text fall on
    one side. Local to each row: no shuffle, whatever the number of copies. A
    null key gives a null mark, never silently a test row.
    """
    names = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    return df.withColumn(split_col, split_mark([F.col(name) for name in names], threshold))
