"""Incremental trigger for the batch ingest (the source project has no streams)."""

from skyledger.streaming.incremental import start_incremental_ingest  # noqa: F401
