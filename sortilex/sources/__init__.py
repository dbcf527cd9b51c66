"""Batch sources and sinks."""

from .commits import Commits, ConflictError
from .document_store import DocumentStore
from .documents import read_documents, write_documents
from .metrics import METRICS_SCHEMA, read_metrics, record_metrics
from .text_files import as_documents, ingest_text_files, stream_text_files

__all__ = [
    "METRICS_SCHEMA",
    "Commits",
    "ConflictError",
    "DocumentStore",
    "as_documents",
    "ingest_text_files",
    "read_documents",
    "read_metrics",
    "record_metrics",
    "stream_text_files",
    "write_documents",
]
