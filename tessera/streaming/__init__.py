"""Structured Streaming forms of the snapshot pipeline."""
