"""Structured Streaming: score trips as they land."""
