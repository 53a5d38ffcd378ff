"""Resumable file ingestion with Structured Streaming."""

from stratal.streaming.incremental import batch_folder_writer, run_available_now, source_stream
from stratal.streaming.ledger import FileLedger, run_changed_files

__all__ = ["FileLedger", "batch_folder_writer", "run_available_now", "run_changed_files", "source_stream"]
