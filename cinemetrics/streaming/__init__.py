"""Structured Streaming form of the per-genre statistics (incremental over arriving files)."""
