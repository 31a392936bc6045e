"""Streaming variant of the table load (stream of closed folders + foreachBatch load)."""

from tidemark.streaming.landing_stream import folder_stream, load_batch, stream_table

__all__ = ["folder_stream", "load_batch", "stream_table"]
