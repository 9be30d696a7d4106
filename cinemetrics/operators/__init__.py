"""Relational operators over ratings DataFrames (joins, aggregates, windows, ALS)."""
