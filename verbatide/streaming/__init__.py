"""The stateless steps on a stream: cleaning and scoring rows as they arrive."""

from verbatide.streaming.ingest import append_stream, clean_stream

__all__ = ["append_stream", "clean_stream"]
