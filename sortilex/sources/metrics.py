"""The evaluation results of every run of an experiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .commits import Commits

# The run is read as a string; left to inference, a run named 1e5 is a number.
METRICS_SCHEMA = "category string, metric string, value double, run_id string"


def record_metrics(metrics: DataFrame, run_id: str, path: str) -> None:
    """Store rows ``(category, metric, value)`` as the results of one run.

    Recording a run again replaces its rows; other runs are not touched, so a
    repeated job leaves the same table. The rows are written beside the old ones
    and count once the list of runs names them: a job killed before that leaves
    the old results readable.
    """
    if not run_id:
        raise ValueError("run_id is empty")
    rows = metrics.selectExpr(
        "cast(category as string) as category",
        "cast(metric as string) as metric",
        "cast(value as double) as value",
    )
    commits = Commits(metrics.sparkSession, path)
    name, folder = commits.new_attempt()
    rows.withColumn("run_id", F.lit(run_id)).write.partitionBy("run_id").parquet(folder)
    number, runs = commits.current()
    commits.replace(number, {**runs, run_id: name})


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Results of all runs; a filter on ``run_id`` reads only that run's files."""
    commits = Commits(spark, path)
    _, runs = commits.current()
    schema = T._parse_datatype_string(METRICS_SCHEMA)
    return commits.read_attempts(schema, [commits.attempt_path(name) for name in runs.values()])
