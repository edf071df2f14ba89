"""Incremental batches as a stream."""
