"""Structured Streaming ingestion: only new files are processed (checkpointed
file source, ``availableNow`` trigger) and each micro-batch is merged into the
lake table idempotently through ``foreachBatch``."""
