"""Operators from DataFrame to DataFrame."""

from .category import category_domain, decode_category, encode_category, reject_unknown_category
from .classifier import ClassifierParams, count_terms, fit_classifier, fit_unsaved, load_classifier
from .evaluation import class_metrics, confusion_matrix, long_metrics, matrix_counts, matrix_metrics
from .scoring import score_batch, score_batch_udf, score_texts_by_length
from .split import split_examples
from .truncate import truncate_documents

__all__ = [
    "ClassifierParams",
    "category_domain",
    "class_metrics",
    "confusion_matrix",
    "count_terms",
    "decode_category",
    "encode_category",
    "fit_classifier",
    "fit_unsaved",
    "load_classifier",
    "long_metrics",
    "matrix_counts",
    "matrix_metrics",
    "reject_unknown_category",
    "score_batch",
    "score_batch_udf",
    "score_texts_by_length",
    "split_examples",
    "truncate_documents",
]
