"""Whole jobs: sources, operators and sinks put together, for tables and for streams."""
