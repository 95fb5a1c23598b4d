"""Structured Streaming entries to the operators that work on one row at a time."""
