"""Incremental (Structured Streaming) form of the document stages."""
