"""Incremental (Structured Streaming) form of the historisation step."""

from immolens.streaming.history_stream import (  # noqa: F401
    gold_stream, historize_available, start_history_stream,
)
