"""Tables written to the shared folder, to cut lineage where executors can be lost."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from ..storage import run_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back."""
    spark: SparkSession = df.sparkSession
    path = run_folder(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_arrow_batches(spark: SparkSession) -> None:
    """Let Spark hand rows to Python in batches of some MB, if the session says nothing else.

    By default a batch has 10,000 rows, which for texts can be more than a task's
    share of memory, both in the JVM and in Python.
    """
    sizes = {"maxRecordsPerBatch": 1_000, "maxBytesPerBatch": 4 << 20}
    for name, size in sizes.items():
        setting = f"spark.sql.execution.arrow.{name}"
        if spark.conf.get(setting, None) is None:
            spark.conf.set(setting, str(size))


class Sent:
    """A fitted model on its way to the tasks; ``get`` unpacks it there once per task.

    It goes as bytes, so that its class need not be installed on the executors. Its
    arrays travel beside it and are read in place, so a task holds them once; they
    cannot be written to there.
    """

    def __init__(self, spark: SparkSession, model) -> None:
        arrays: list = []
        body = cloudpickle.dumps(model, protocol=5, buffer_callback=arrays.append)
        self._parts = spark.sparkContext.broadcast((body, [a.raw().tobytes() for a in arrays]))

    def get(self):
        body, arrays = self._parts.value
        return cloudpickle.loads(body, buffers=arrays)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name = f"_{name}"
    return name
