"""Structured Streaming. The transformations work on batch and streaming frames alike."""
