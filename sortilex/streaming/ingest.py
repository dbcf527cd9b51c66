"""Bring the files of a volume into the document store as they arrive."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.document_store import DocumentStore
from ..sources.text_files import as_documents, stream_text_files
from ..sources.volume_files import VolumeFiles, plain_path


@dataclass
class Triggers:
    """How many triggers of a query have begun and ended."""

    begun: int = 0
    ended: int = 0


class VolumeQuery(StreamingQuery):
    """A query whose triggers look for new files themselves."""

    triggers: Triggers

    def processAllAvailable(self) -> None:
        """Wait for a trigger that begins after this call, and so finds the files there now."""
        wanted = self.triggers.begun + 1
        while self.isActive and self.triggers.ended < wanted:
            time.sleep(0.05)
        if failure := self.exception():
            raise failure


def ingest_volume(
    spark: SparkSession,
    volume_path: str,
    store: DocumentStore,
    checkpoint: str,
    path_glob: str | None = None,
    max_files_per_trigger: int | None = None,
    archive_path: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that stores each new file of the volume as one document.

    Rows are ``(doc_id, category, text)`` (see ``as_documents``). A run from the same
    checkpoint takes only files that no earlier run took, and a batch that is run
    again after a failure is not stored twice. By default the query takes what has
    arrived and stops; ``trigger={"processingTime": "1 minute"}`` keeps it running.

    On paths that are plain files to all machines tasks find the files, and the
    checkpoint has tables of those taken (see ``VolumeFiles``): a trigger looks for
    new files and stores them, ``max_files_per_trigger`` at a time. On other file
    systems, and for patterns of folders, Spark's own source does, whose driver holds
    the paths of the volume (see ``stream_text_files``).
    """
    paths = [volume_path] if archive_path is None else [volume_path, archive_path]
    if any(plain_path(spark, path) is None for path in paths):
        files = stream_text_files(spark, volume_path, path_glob, max_files_per_trigger, archive_path)

        def put(batch: DataFrame, batch_id: int) -> None:
            store.put(batch, batch_id=f"{checkpoint}#{batch_id}")

        return _started(as_documents(files, volume_path), put, checkpoint, trigger)
    triggers = Triggers()
    volume = VolumeFiles(spark, volume_path, f"{checkpoint}/files", path_glob, archive_path, checkpoint)

    def put_new(batch: DataFrame, batch_id: int) -> None:
        triggers.begun += 1
        for name, files in volume.new_batches(max_files_per_trigger):
            store.put(as_documents(files, volume_path), batch_id=f"{checkpoint}#{name}")
        triggers.ended += 1

    # A source that gives one row per trigger, which nobody reads.
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    query = VolumeQuery(_started(ticks, put_new, f"{checkpoint}/triggers", trigger)._jsq)
    query.triggers = triggers
    return query


def _started(rows: DataFrame, put, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
