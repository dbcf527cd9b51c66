"""Whole jobs put together from the operators."""

from .examples import attach_labels, count_examples, label_coverage, prepare_examples, with_text
from .ingest import document_store, ingest_documents
from .registry import ModelVersions
from .serve import (
    load_registered,
    read_promoted,
    score_table,
    score_to_endpoint,
    serve,
    serve_promoted,
)
from .train import fit_and_evaluate, train

__all__ = [
    "ModelVersions",
    "attach_labels",
    "count_examples",
    "document_store",
    "fit_and_evaluate",
    "ingest_documents",
    "label_coverage",
    "load_registered",
    "prepare_examples",
    "read_promoted",
    "score_table",
    "score_to_endpoint",
    "serve",
    "serve_promoted",
    "train",
    "with_text",
]
