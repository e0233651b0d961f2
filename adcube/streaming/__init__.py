"""Structured Streaming trigger for the incremental runs."""

from .incremental import start_staging_stream

__all__ = ["start_staging_stream"]
