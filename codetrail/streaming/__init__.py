"""Structured Streaming forms of the models (file source, foreachBatch keyed upserts)."""
