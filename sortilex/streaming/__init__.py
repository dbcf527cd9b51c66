"""Structured Streaming entry points."""

from .ingest import ingest_volume
from .promoted import score_promoted_stream
from .score import score_stream, stream_documents

__all__ = ["ingest_volume", "score_promoted_stream", "score_stream", "stream_documents"]
