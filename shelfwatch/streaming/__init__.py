"""Structured Streaming form of the snapshot chain."""
