"""Incremental hand-over from landed objects to tables."""
