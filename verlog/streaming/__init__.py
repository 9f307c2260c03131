"""Structured Streaming over a change log."""
