"""Score documents as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import score_batch
from ..settings import CATEGORY_LIST


def stream_documents(
    spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files arriving in a folder, as a stream.

    ``max_files_per_trigger`` bounds one micro-batch, for a first run over a
    large backlog.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def score_stream(
    stream_df: DataFrame,
    model: PipelineModel | Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    categories=CATEGORY_LIST,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that appends the scores of ``stream_df`` to Parquet at ``out``.

    ``model`` is a fitted pipeline, or a function that scores a DataFrame, such
    as ``score_batch_udf`` with its arguments bound. The query keeps no state,
    so it needs no watermark and no shuffle, and a late row is scored like any
    other. Each input row is written once, also after a restart from the same
    ``checkpoint``. By default it scores what has arrived and stops; pass
    ``trigger={"processingTime": "1 minute"}`` to keep it running. A new model
    takes effect on a restart.
    """
    scored = model(stream_df) if callable(model) else score_batch(stream_df, model, categories)
    writer = (
        scored.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    if name is not None:
        writer = writer.queryName(name)
    return writer.start()
