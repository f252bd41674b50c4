"""Structured Streaming jobs. All run with ``availableNow`` or on a processing-time trigger."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Process what is there and stop, or poll at an interval such as ``20 minutes``."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
