"""Structured Streaming: the flagship feed-increment stream and helpers."""
