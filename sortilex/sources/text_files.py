"""A folder of text files as rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader


def is_never_packed(spark: SparkSession, path_glob: str | None) -> bool:
    """Whether all names of a glob end in a suffix that stands for no compression."""
    tail = re.split(r"[*?\]}\\]", path_glob or "")[-1]
    if "." not in tail:
        return False
    hadoop = spark._jvm.org.apache.hadoop
    codecs = hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    return codecs.getCodec(hadoop.fs.Path(f"name{tail}")) is None


def _read(
    spark: SparkSession,
    reader: DataFrameReader | DataStreamReader,
    volume_path: str | list[str],
    path_glob: str | None,
) -> DataFrame:
    """Rows ``(path, folder, content)`` of the files below a folder, or of some files."""
    options = {"recursiveFileLookup": True, "pathGlobFilter": path_glob}
    if is_never_packed(spark, path_glob):
        # The text source sets up a Hadoop job and looks for all codecs at each file.
        schema = "path string, modificationTime timestamp, length long, content binary"
        files = reader.schema(schema).format("binaryFile").load(volume_path, **options)
        value = F.col("content").cast("string")
    else:
        files, value = reader.text(volume_path, wholetext=True, **options), F.col("value")
    # The file path is URI-encoded; a plus sign in it stands for itself.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return files.select(
        path.alias("path"),
        F.element_at(F.split(path, "/"), -2).alias("folder"),
        F.make_valid_utf8(value).alias("content"),
    )


def ingest_text_files(
    spark: SparkSession, volume_path: str, path_glob: str | None = None
) -> DataFrame:
    """One row ``(path, folder, content)`` per UTF-8 file at any depth.

    ``folder`` is the name of the file's own folder. ``path_glob`` filters file
    names. Bytes that are no UTF-8 become U+FFFD. Each file is one row, so each
    must fit into a task; small ones are packed into shared tasks. The driver
    lists the folder and holds a path and a size per file: for folders of very many
    files use ``stream_text_files``, whose runs take a part each. As in every
    Spark file source, a file of zero bytes, or one whose name starts with a dot or
    underscore, gives no row. Compressed files are unpacked. If no name that the glob
    allows can be one (as in ``*.txt``), a file costs about a millisecond, else four.
    """
    return _read(spark, spark.read, volume_path, path_glob)


def read_text_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The rows of ``ingest_text_files`` for files named one by one; the driver holds them."""
    # A name is no pattern, whatever it has in it.
    return _read(spark, spark.read.option("__globPaths__", False), paths, None)


def stream_text_files(
    spark: SparkSession,
    volume_path: str,
    path_glob: str | None = None,
    max_files_per_trigger: int | None = None,
    archive_path: str | None = None,
) -> DataFrame:
    """The rows of ``ingest_text_files`` as a stream: each file once, as it arrives.

    A file is known by its path; one that changes later is not read anew. The
    checkpoint of the query keeps the paths taken, and the driver holds them while
    it runs. ``max_files_per_trigger`` bounds one batch. With ``archive_path``
    files move there after their batch, so that later listings of the folder see
    new files alone; it must lie outside the folder.
    """
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_path is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_path)
    return _read(spark, reader, volume_path, path_glob)


def as_documents(files: DataFrame, volume_path: str) -> DataFrame:
    """Rows ``(doc_id, category, text)`` of files: the folder's name is the category.

    ``doc_id`` is the SHA-256 of the path below ``volume_path``, so a volume that is
    copied elsewhere gives the same ids. A file of the volume's own folder has the
    category of that folder's name.
    """
    # Only what follows the volume's path counts, whatever the scheme before it.
    root = volume_path.rpartition(":")[2].strip("/")
    below = F.substring_index("path", f"/{root}/", -1)
    return files.select(
        F.sha2(below, 256).alias("doc_id"),
        F.col("folder").alias("category"),
        F.col("content").alias("text"),
    )
