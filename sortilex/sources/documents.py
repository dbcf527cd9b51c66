"""The document table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WRITE_MODES = ("append", "overwrite", "error", "errorifexists", "ignore")


def read_documents(
    spark: SparkSession, table_name: str | None = None, path: str | None = None
) -> DataFrame:
    """Scan a named table, or the Parquet files at a path."""
    if (table_name is None) == (path is None):
        raise ValueError("give a table name or a path, and not both")
    return spark.table(table_name) if path is None else spark.read.parquet(path)


def write_documents(
    df: DataFrame,
    table_name: str,
    mode: str = "append",
    path: str | None = None,
    partition_by=(),
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Store documents in a named table.

    The rows are written where they are, without a shuffle. ``path`` makes the
    table external. ``bucket_by=(n, key)`` spares later joins on ``key`` their
    shuffle; repartition by the key first, or each task writes n files.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, not {mode!r}")
    writer = df.write.format("parquet").mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(table_name)
