"""Score a batch or a stream of rows; local to each row."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import category_name, has_text
from ..settings import CATEGORY_LIST, check_categories
from .classifier import TEXT_COL, WORK_COLS

SCORE_COLS = ("prediction", "predicted_category", "confidence")


def _check_free(df: DataFrame, names) -> None:
    taken = [name for name in names if name in df.columns]
    if taken:
        raise ValueError(f"scoring needs these column names, which the input has: {taken}")


def score_batch(df: DataFrame, model: PipelineModel, categories=CATEGORY_LIST) -> DataFrame:
    """Add ``prediction`` (class id), ``predicted_category`` and ``confidence``.

    ``confidence`` is the probability of the predicted class. Every row stays;
    one whose ``truncated_text`` is null or empty gets null scores. Works on a
    stream too.
    """
    _check_free(df, SCORE_COLS + WORK_COLS)
    names = check_categories(categories)
    scorable = has_text(F.col(TEXT_COL))
    given = model.transform(df)
    label = F.when(scorable, F.col("prediction").cast("int"))
    return given.select(
        *(F.col(f"`{name}`") for name in df.columns),
        label.alias("prediction"),
        category_name(label, names).alias("predicted_category"),
        F.when(scorable, F.array_max(vector_to_array("probability"))).alias("confidence"),
    )


def _valid_inputs(df: DataFrame, names, shapes):
    """Whether a row can be scored, and the inputs with a stand-in where it cannot."""
    shapes = list(shapes) if shapes is not None else [None] * len(names)
    tests, stand_ins = [], []
    for name, shape in zip(names, shapes, strict=True):
        column, kind = F.col(name), df.schema[name].dataType
        test = column.isNotNull()
        if isinstance(kind, T.ArrayType):
            size = math.prod(shape) if shape else 0
            test &= F.forall(column, lambda x: x.isNotNull())
            if shape:
                test &= F.size(column) == size
            stand_in = F.array_repeat(F.lit("0").cast(kind.elementType), size)
        else:
            stand_in = F.lit("0").cast(kind)
        tests.append(F.coalesce(test, F.lit(False)))
        stand_ins.append(stand_in)
    valid = reduce(lambda a, b: a & b, tests)
    inputs = [F.when(valid, F.col(n)).otherwise(s) for n, s in zip(names, stand_ins, strict=True)]
    return valid, inputs


def score_batch_udf(
    df: DataFrame,
    make_predict_fn,
    input_cols,
    categories=CATEGORY_LIST,
    input_tensor_shapes=None,
    batch_size: int = 1024,
) -> DataFrame:
    """The scores of ``score_batch``, from a model the caller supplies.

    ``make_predict_fn`` is called once in a Python worker and returns a function
    from numpy batches of ``input_cols`` to one row of class scores per input
    row. The first of several highest scores wins. Put filters and column
    selection before this call; each remaining row crosses to Python once.

    Every row stays. One whose input is null, holds a null or has not as many
    values as its shape in ``input_tensor_shapes`` gets null scores. A model
    that returns more scores than there are categories fails the job.
    """
    _check_free(df, SCORE_COLS)
    names = check_categories(categories)
    input_cols = list(input_cols)
    valid, inputs = _valid_inputs(df, input_cols, input_tensor_shapes)
    predict = predict_batch_udf(
        make_predict_fn,
        return_type=T.ArrayType(T.DoubleType()),
        batch_size=batch_size,
        input_tensor_shapes=input_tensor_shapes,
    )
    scored = df.withColumn("__scores", predict(*inputs))
    scored = scored.withColumn("__scores", F.when(valid, F.col("__scores")))
    return _decoded(scored, df.columns, names)


def _in_order_of_length(batches, make_predict_fn, at: int, batch_size: int, buffer_rows: int, buffer_chars: int):
    """Record batches with scores appended; texts meet the model sorted by length."""
    predict = make_predict_fn()

    def scored(buffer):
        whole = pa.Table.from_batches(buffer)
        texts = whole.column(at)
        lengths = pc.fill_null(pc.utf8_length(texts), 0).to_numpy()
        some = np.flatnonzero(lengths)
        order = some[np.argsort(lengths[some], kind="stable")]
        scores = [None] * len(texts)
        for k in range(0, len(order), batch_size):
            rows = order[k : k + batch_size]
            given = np.asarray(predict(np.array(texts.take(rows).to_pylist(), object)), float)
            for row, values in zip(rows.tolist(), given.tolist(), strict=True):
                scores[row] = values
        column = pa.array(scores, pa.list_(pa.float64()))
        yield from whole.append_column("__scores", column).to_batches()

    buffer, rows, chars = [], 0, 0
    for batch in batches:
        buffer.append(batch)
        rows += batch.num_rows
        chars += batch.column(at).nbytes
        if rows >= buffer_rows or chars >= buffer_chars:
            yield from scored(buffer)
            buffer, rows, chars = [], 0, 0
    if rows:
        yield from scored(buffer)


def score_texts_by_length(
    df: DataFrame,
    make_predict_fn,
    text_col: str = TEXT_COL,
    categories=CATEGORY_LIST,
    batch_size: int = 64,
    buffer_rows: int = 16_384,
    buffer_bytes: int = 64 << 20,
) -> DataFrame:
    """The scores of ``score_batch_udf`` for a model of texts that pads its batches.

    ``make_predict_fn`` is called once per task and returns a function from a numpy
    batch of texts to one row of class scores each. A task gathers rows up to
    ``buffer_rows`` or ``buffer_bytes``, sorts them by the length of their text and
    hands over ``batch_size`` texts of like length at a time, so a model that pads
    each batch to its longest text pads next to nothing. The rows come back in the
    order they had. A null or empty text gets null scores and is not handed over.
    """
    _check_free(df, SCORE_COLS)
    names, at = check_categories(categories), df.columns.index(text_col)
    schema = T.StructType([*df.schema.fields, T.StructField("__scores", T.ArrayType(T.DoubleType()))])

    def run(batches):
        return _in_order_of_length(batches, make_predict_fn, at, batch_size, buffer_rows, buffer_bytes)

    return _decoded(df.mapInArrow(run, schema), df.columns, names)


def _decoded(scored: DataFrame, columns, names) -> DataFrame:
    """The score columns from ``__scores``, one value per class or null."""
    fits = F.size("__scores") <= len(names)
    refused = F.raise_error(F.lit("the model returns more scores than there are categories"))
    checked = F.when(F.col("__scores").isNull() | fits, F.col("__scores")).otherwise(refused)
    scored = scored.withColumn("__scores", checked)
    best = F.array_max("__scores")
    label = (F.array_position("__scores", best) - 1).cast("int")
    return scored.select(
        *(F.col(f"`{name}`") for name in columns),
        label.alias("prediction"),
        category_name(label, names).alias("predicted_category"),
        best.alias("confidence"),
    )
