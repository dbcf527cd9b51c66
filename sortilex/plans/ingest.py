"""From the files of the volume to the document table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..settings import Settings
from ..sources.document_store import BUCKETS, DocumentStore
from ..streaming import ingest_volume

_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTED_BY_DRIVER = "spark.sql.sources.parallelPartitionDiscovery.threshold"


def document_store(spark: SparkSession, settings: Settings, buckets: int = BUCKETS) -> DocumentStore:
    """The store of the project's documents."""
    return DocumentStore(spark, settings.documents_path, "doc_id", buckets)


def ingest_documents(
    spark: SparkSession,
    settings: Settings,
    path_glob: str | None = None,
    max_files_per_trigger: int | None = None,
    archive_path: str | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Store the files that are new in the volume; returns all documents stored.

    Rows are ``(doc_id, category, text)``, fit for ``train(documents, "category", settings)``.
    """
    store = document_store(spark, settings, buckets)
    with _listed_in_few_tasks(spark):
        ingest_volume(
            spark,
            settings.volume_path,
            store,
            settings.ingest_checkpoint_path,
            path_glob,
            max_files_per_trigger,
            archive_path,
        ).awaitTermination()
    return store.read()


@contextmanager
def _listed_in_few_tasks(spark: SparkSession) -> Iterator[None]:
    """List the volume's folders, and look up the files of a batch, in a few tasks per core.

    Spark would start up to 10,000 tasks for the files, of a few each, and twice in a
    run that follows another. Up to 32 folders side by side it would list in the
    driver, one after the other, each run anew with all files that earlier runs took.
    The source asks the session for both at each batch.
    """
    before = {name: spark.conf.get(name) for name in (_LISTING_TASKS, _LISTED_BY_DRIVER)}
    few = 4 * spark.sparkContext.defaultParallelism
    spark.conf.set(_LISTING_TASKS, str(min(int(before[_LISTING_TASKS]), few)))
    spark.conf.set(_LISTED_BY_DRIVER, str(min(int(before[_LISTED_BY_DRIVER]), 1)))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
