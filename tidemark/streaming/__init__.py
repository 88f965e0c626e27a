"""Landing folders as file streams."""

from tidemark.streaming.file_stream import (
    bar_stream,
    gold_stream,
    rate_stream,
    run_available,
    spread_stream,
)

__all__ = ["bar_stream", "gold_stream", "rate_stream", "run_available", "spread_stream"]
