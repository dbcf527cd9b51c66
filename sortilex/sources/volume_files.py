"""The files of a volume, found, remembered and read by tasks: the driver holds no path.

For volumes on paths that are plain files to all machines; tasks list and open them
themselves.
"""

from __future__ import annotations

import errno
import json
import os
import shutil
import stat
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import remove_folder, run_folder
from .commits import Commits
from .text_files import is_never_packed, read_text_files

# Executors need no copy of the library: the tasks' functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Lists of taken files, one per run that found some, are joined into one beyond this.
MAX_LISTS = 16
# A task reads about as many files, or as many bytes, before the next task does.
TASK_FILES = 4_000
TASK_BYTES = 64 << 20
_BATCH_ROWS = 5_000
_BATCH_BYTES = 8 << 20

_FOUND = "path binary, modified long, length long, is_folder boolean"
_LISTED = T.StructType().add("path", "binary").add("length", "long").add("part", "long")


def plain_path(spark: SparkSession, path: str) -> str | None:
    """A path as tasks can open it, None if it is a glob or lies on another file system."""
    if set(path) & set("{}[]*?\\"):
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    uri = path.getFileSystem(conf).makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of each folder, without those that Spark's file sources pass over."""

    def rows():
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                try:
                    entries = os.scandir(folder)
                except FileNotFoundError:
                    continue
                except NotADirectoryError:
                    # A volume may be a single file.
                    about = os.stat(folder)
                    yield folder, about.st_mtime_ns, about.st_size, False
                    continue
                with entries:
                    yield from filter(None, map(row, entries))

    def row(entry):
        name = entry.name
        hidden = name.startswith(b".") or name.endswith(b"._COPYING_") or (name.startswith(b"_") and b"=" not in name)
        try:
            if entry.is_dir():
                hidden = hidden and not name.startswith((b"_metadata", b"_common_metadata"))
                return None if hidden else (entry.path, None, None, True)
            about = None if hidden else entry.stat()
        except OSError as gone:
            # Deleted since, or a link to nothing or to itself.
            if gone.errno in (errno.ENOENT, errno.ELOOP):
                return None
            raise
        # A pipe or a device has nothing to read.
        return about and (entry.path, about.st_mtime_ns, about.st_size if stat.S_ISREG(about.st_mode) else 0, False)

    def packed(some):
        columns = zip(*some, strict=True)
        types = (pa.binary(), pa.int64(), pa.int64(), pa.bool_())
        names = ["path", "modified", "length", "is_folder"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    some = []
    for one in rows():
        some.append(one)
        if len(some) == _BATCH_ROWS:
            yield packed(some)
            some = []
    if some:
        yield packed(some)


def _contents(batches: Iterator[pa.RecordBatch], may_miss: bool) -> Iterator[pa.RecordBatch]:
    """Rows ``(path, content)`` of files; an empty file gives none."""

    def packed(paths, contents):
        columns = [pa.array(paths, pa.binary()), pa.array(contents, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["path", "content"])

    paths, contents, size = [], [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            try:
                with open(path, "rb", buffering=0) as file:
                    content = file.read()
            except FileNotFoundError:
                if may_miss:
                    continue
                raise
            if content:
                paths.append(path)
                contents.append(content)
                size += len(content)
            if size >= _BATCH_BYTES or len(paths) == _BATCH_ROWS:
                yield packed(paths, contents)
                paths, contents, size = [], [], 0
    if paths:
        yield packed(paths, contents)


def _moved(batches: Iterator[pa.RecordBatch], archive: bytes) -> Iterator[pa.RecordBatch]:
    """Move files below the archive, each under its whole path; how many went."""
    n = 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            to = archive + path
            try:
                os.makedirs(os.path.dirname(to), exist_ok=True)
                shutil.move(path, to)
                n += 1
            except OSError:
                # As in Spark's own archive, a file that cannot move stays.
                continue
    yield pa.RecordBatch.from_pydict({"n": [n]})


class VolumeFiles:
    """The files of a volume, each handed over once, whatever the number of runs.

    Tasks walk the folders level by level, compare what they find with the lists of
    files taken before, and read the new ones. A list is a table below ``log_path``;
    ``Commits`` says which lists hold and how much of the last one is done, so a run
    that was cut off goes on with the files that it had found. The driver holds the
    names of the lists, and of a run's files their number alone.

    With ``archive_path`` files move there after their batch. Files that a query of
    Spark's own file source took from the checkpoint ``earlier`` count as taken.
    """

    def __init__(
        self,
        spark: SparkSession,
        volume_path: str,
        log_path: str,
        path_glob: str | None = None,
        archive_path: str | None = None,
        earlier: str | None = None,
    ) -> None:
        self.spark, self.path_glob, self.earlier = spark, path_glob, earlier
        self.root = plain_path(spark, volume_path)
        if self.root is None:
            raise ValueError(f"{volume_path} is no plain path")
        self.archive = None if archive_path is None else self._outside(archive_path)
        self.commits = Commits(spark, log_path)

    def new_batches(self, max_files: int | None = None) -> Iterator[tuple[str, DataFrame]]:
        """A name and rows ``(path, folder, content)`` per batch of new files.

        A batch counts as taken once the next one is asked for; one that was not comes
        again under the same name. ``max_files`` bounds a batch, the files that
        changed longest ago first.
        """
        if max_files is not None and max_files < 1:
            raise ValueError("max_files must be at least 1")
        archive = self.archive
        number, state = self.commits.current()
        if not state:
            number, state = self._begin(number)
        for cut_off in (True, False):
            if not cut_off:
                number, state = self._find(number, state, max_files)
            while state["done"] < state["parts"]:
                name = state["lists"][-1]
                files = self._lists([name]).filter(F.col("part") == state["done"])
                yield f"{name}.{state['done']}", self._read(files, cut_off)
                if archive is not None:
                    moved = files.select("path").mapInArrow(lambda batches: _moved(batches, archive), "n long")
                    # The sum makes the job run.
                    moved.agg(F.sum("n")).collect()
                state = {**state, "done": state["done"] + 1}
                number = self.commits.replace(number, state)

    def _outside(self, archive_path: str) -> bytes:
        archive = plain_path(self.spark, archive_path)
        if archive is None or f"{archive}/".startswith(f"{self.root.rstrip('/')}/"):
            raise ValueError(f"{archive_path} must be a plain path outside {self.root}")
        return os.fsencode(archive.rstrip("/"))

    def _lists(self, names: list[str]) -> DataFrame:
        return self.commits.read_attempts(_LISTED, [self.commits.attempt_path(n) for n in names])

    def _begin(self, number: int) -> tuple[int, dict]:
        """No lists, or that of the files which Spark's own source took and finished."""
        state = {"lists": [], "parts": 0, "done": 0}
        finished = [] if self.earlier is None else self.commits.numbers(f"{self.earlier}/commits", "")
        if not finished:
            return number, state
        lines = self.spark.read.text(f"{self.earlier}/offsets/{finished[-1]}", wholetext=True).first()[0]
        last = json.loads(lines.splitlines()[-1])["logOffset"]
        entries = self.spark.read.schema("path string, batchId long").json(f"{self.earlier}/sources/0")
        path = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
        name, folder = self.commits.new_attempt()
        entries.filter(F.col("batchId") <= last).select(
            F.regexp_replace(path, "^file:/+", "/").cast("binary").alias("path"),
            F.lit(None).cast("long").alias("length"),
            F.lit(None).cast("long").alias("part"),
        ).write.parquet(folder)
        state["lists"].append(name)
        return self.commits.replace(number, state), state

    def _walk(self, work: str) -> DataFrame:
        """All entries below the volume; a job per level of folders."""
        folders, n, levels = self.spark.range(1).select(F.lit(self.root).cast("binary").alias("path")), 1, []
        most = 4 * self.spark.sparkContext.defaultParallelism
        while n:
            levels.append(f"{work}/level-{len(levels)}")
            spread = folders.repartition(min(n, most)) if n > 1 else folders
            spread.mapInArrow(_scan, _FOUND).write.parquet(levels[-1])
            folders = self.spark.read.schema(_FOUND).parquet(levels[-1]).filter("is_folder").select("path")
            n = folders.count()
        return self.spark.read.schema(_FOUND).parquet(*levels)

    def _named(self, path: Column) -> Column:
        """Whether the glob has a file's name."""
        if self.path_glob is None:
            return F.lit(True)
        pattern = self.spark._jvm.org.apache.hadoop.fs.GlobPattern(self.path_glob).compiled().pattern()
        return F.substring_index(path, "/", -1).rlike(rf"(?s)\A(?:{pattern})\z")

    def _find(self, number: int, state: dict, max_files: int | None) -> tuple[int, dict]:
        """Put the files that no list has into a new list."""
        work = run_folder(self.spark, "volume-listing")
        try:
            found = self._walk(f"{work}/levels").filter("not is_folder").filter(self._named(_text("path")))
            taken = self._lists(state["lists"])
            # One group per path in place of a join: neither side is ever broadcast.
            both = found.select("path", "modified", "length", F.lit(False).alias("taken")).unionByName(
                taken.select("path", F.lit(True).alias("taken")), allowMissingColumns=True
            )
            ends = (F.max(c).alias(c) for c in ("modified", "length", "taken"))
            new = both.groupBy("path").agg(*ends).filter("not taken")
            part = F.lit(0).cast("long")
            if max_files is not None:
                new, nth = self._numbered(new, f"{work}/sorted")
                part = F.floor(nth / max_files).cast("long")
            name, folder = self.commits.new_attempt()
            new.select("path", "length", part.alias("part")).write.parquet(folder)
        finally:
            remove_folder(self.spark, work)
        last = self._lists([name]).agg(F.max("part")).first()[0]
        if last is None:
            remove_folder(self.spark, folder)
            return number, state
        lists = [*state["lists"], name]
        if len(lists) > MAX_LISTS:
            joined, folder = self.commits.new_attempt()
            self._lists(lists[:-1]).write.parquet(folder)
            lists = [joined, name]
        state = {"lists": lists, "parts": last + 1, "done": 0}
        number = self.commits.replace(number, state)
        if len(lists) == 2:
            self.commits.remove_unlisted(set(lists))
        return number, state

    def _numbered(self, files: DataFrame, path: str) -> tuple[DataFrame, Column]:
        """Files by time and path, and a column that counts them from 0."""
        ordered = files.orderBy("modified", "path")
        # The id counts from 0 in each task, above the task's number.
        ordered.withColumn("id", F.monotonically_increasing_id()).write.parquet(path)
        stored = self.spark.read.parquet(path)
        task = F.shiftright("id", 33)
        counts = sorted(map(tuple, stored.groupBy(task).count().collect()))
        before, starts = 0, []
        for number, n in counts:
            starts += [F.lit(number), F.lit(before)]
            before += n
        start = F.element_at(F.create_map(*starts), task) if starts else F.lit(0)
        return stored, start + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))

    def _read(self, files: DataFrame, cut_off: bool) -> DataFrame:
        """Rows ``(path, folder, content)`` of listed files.

        Of a list that an earlier run had made, files may be gone by now.
        """
        # What was empty when it was found has no row, as in Spark's file sources.
        files = files.filter("length > 0")
        spark, own, others = self.spark, files, []
        if not is_never_packed(spark, self.path_glob):
            packed = F.lit(False)
            for suffix in _packed_suffixes(spark):
                packed |= _text("path").endswith(suffix)
            own, others = files.filter(~packed), files.filter(packed).select("path").collect()
            others = [bytes(r[0]).decode("utf-8", "replace") for r in others if not cut_off or os.path.exists(r[0])]
        n, size = own.agg(F.count("*"), F.sum("length")).first()
        tasks = max(n // TASK_FILES, (size or 0) // TASK_BYTES, min(n, spark.sparkContext.defaultParallelism), 1)
        # Long lists come in few splits; opening files takes the time.
        read = own.select("path").repartition(tasks).mapInArrow(
            lambda batches: _contents(batches, cut_off), "path binary, content binary"
        )
        path = _uri("path")
        rows = read.select(
            path.alias("path"),
            F.element_at(F.split(path, "/"), -2).alias("folder"),
            F.make_valid_utf8(F.col("content").cast("string")).alias("content"),
        )
        if others:
            # Spark unpacks; the driver holds the paths of packed files.
            rows = rows.unionByName(read_text_files(spark, [f"file://{path}" for path in others]))
        return rows


def _text(path: str) -> Column:
    return F.make_valid_utf8(F.col(path).cast("string"))


def _uri(path: str) -> Column:
    return F.concat(F.lit("file://"), _text(path))


def _packed_suffixes(spark: SparkSession) -> list[str]:
    """The ends of names by which Hadoop knows compressed files."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    classes = hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    return sorted({hadoop.util.ReflectionUtils.newInstance(c, conf).getDefaultExtension() for c in classes})
