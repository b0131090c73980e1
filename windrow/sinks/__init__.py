"""Sinks: time-bucketed folders, compaction of their files."""
