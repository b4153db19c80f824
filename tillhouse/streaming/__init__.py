"""Streaming entry points.  The reference has no streams; its incremental
load is a scheduled batch.  ``file_landing`` offers the same incremental
landing for file sources on Structured Streaming (checkpointed, availableNow)."""

from tillhouse.streaming.file_landing import land_new_files  # noqa: F401
