"""Structured Streaming: incremental, exactly-once raw loads of arriving files."""

from .ingest import ingest_new_files, raw_file_stream

__all__ = ["ingest_new_files", "raw_file_stream"]
