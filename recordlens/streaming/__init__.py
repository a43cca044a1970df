"""Bounded Structured Streaming ingest (file source, ``availableNow``)."""
