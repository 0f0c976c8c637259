"""Streaming form of the bar aggregation (A1 with a watermark)."""

from tickwork.streaming.bars import stream_bars

__all__ = ["stream_bars"]
