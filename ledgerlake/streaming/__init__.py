"""Structured Streaming entry points."""

from ledgerlake.streaming.posting_stream import start_posting_stream, post_stream  # noqa: F401
