"""Streams of progress events."""
