"""A scoring stream whose model can change between two batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _is_written(spark: SparkSession, path: str) -> bool:
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def score_promoted_stream(
    stream_df: DataFrame,
    current_version: Callable[[], int],
    scorer: Callable[[int], Callable[[DataFrame], DataFrame]],
    out: str,
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that scores each batch with the version current when it begins.

    ``current_version`` is asked once per batch, and ``scorer`` gives the function
    that scores a DataFrame with a version; the last one is kept. Scores go to
    ``out/batch=<id>`` with the column ``model_version``. A batch that is run again
    after a failure writes nothing if its folder is complete, and else replaces it
    whole, so each input row is written once. Use one checkpoint per ``out``.
    """
    kept: dict[int, Callable[[DataFrame], DataFrame]] = {}

    def score(batch: DataFrame, batch_id: int) -> None:
        folder = f"{out}/batch={batch_id}"
        if _is_written(batch.sparkSession, folder):
            return
        version = current_version()
        if version not in kept:
            kept.clear()
            kept[version] = scorer(version)
        scored = kept[version](batch).withColumn("model_version", F.lit(version))
        scored.write.mode("overwrite").parquet(folder)

    writer = (
        stream_df.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    if name is not None:
        writer = writer.queryName(name)
    return writer.start()
