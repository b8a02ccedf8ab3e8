"""Incremental ingest."""

from .ingest import each_new_batch, ingest_new_files
from .resent import SENT, append_marked, append_once, with_marks, without_marks

__all__ = [
    "SENT", "append_marked", "append_once", "each_new_batch", "ingest_new_files", "with_marks", "without_marks",
]
