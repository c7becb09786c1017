"""Incremental (Structured Streaming) form of the arrival fact load."""

from stellate.streaming.incremental import start_fact_stream  # noqa: F401
