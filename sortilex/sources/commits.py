"""Which stored attempts count: a small list that readers obey.

A job writes its rows to a folder of its own, an attempt, and only then replaces the
list of the attempts that count, by renaming one finished file. A job that dies
before the rename has changed nothing that a reader sees.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KEPT_LISTS = 20


class ConflictError(RuntimeError):
    """Another writer has replaced the list in the meantime; read it and try again."""


class Commits:
    """The lists below ``root``, the last of which holds. One file per replacement.

    A list is a dictionary; the driver holds it, so it must name parts (runs,
    buckets, versions), never rows. Writers must take turns: one that finds that its
    number is taken gets a ``ConflictError``.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._folder = self._path(f"{self.root}/commits")
        self._fs = self._folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _numbers(self) -> list[int]:
        return self.numbers(f"{self.root}/commits", ".json")

    def numbers(self, folder: str, suffix: str) -> list[int]:
        """The numbers that files of a folder have for names, in order."""
        folder = self._path(folder)
        if not self._fs.exists(folder):
            return []
        names = (f.getPath().getName() for f in self._fs.listStatus(folder))
        stems = (n.removesuffix(suffix) for n in names if n.endswith(suffix))
        return sorted(int(n) for n in stems if n.isdigit())

    def current(self) -> tuple[int, dict]:
        """Number and content of the list that holds; 0 and nothing before the first."""
        numbers = self._numbers()
        if not numbers:
            return 0, {}
        stream = self._fs.open(self._path(f"{self.root}/commits/{numbers[-1]:012d}.json"))
        try:
            return numbers[-1], json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def replace(self, after: int, content: dict) -> int:
        """Put ``content`` in place of list ``after``; returns its number."""
        number = after + 1
        final = self._path(f"{self.root}/commits/{number:012d}.json")
        unfinished = self._path(f"{self.root}/commits/_{number:012d}-{uuid.uuid4().hex}")
        stream = self._fs.create(unfinished, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        if self._fs.exists(final) or not self._fs.rename(unfinished, final):
            self._fs.delete(unfinished, False)
            raise ConflictError(f"list {number} of {self.root} exists already")
        for old in self._numbers()[:-KEPT_LISTS]:
            self._fs.delete(self._path(f"{self.root}/commits/{old:012d}.json"), False)
        return number

    def new_attempt(self) -> tuple[str, str]:
        """A name that no attempt had, and its folder."""
        name = uuid.uuid4().hex
        return name, self.attempt_path(name)

    def attempt_path(self, name: str) -> str:
        return f"{self.root}/data/attempt={name}"

    def read_attempts(self, schema: T.StructType, paths: list[str]) -> DataFrame:
        """The rows of some attempt folders (or partition folders in them), without their names."""
        given = T.StructType([*schema.fields, T.StructField("attempt", T.StringType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(given).option("basePath", f"{self.root}/data").parquet(*paths)
        return rows.select(*(f"`{name}`" for name in schema.names))

    def remove_unlisted(self, names: set[str]) -> int:
        """Delete attempts other than ``names``; for times when nobody writes or reads."""
        folder, removed = self._path(f"{self.root}/data"), 0
        if self._fs.exists(folder):
            for status in self._fs.listStatus(folder):
                if status.getPath().getName().removeprefix("attempt=") not in names:
                    self._fs.delete(status.getPath(), True)
                    removed += 1
        return removed
