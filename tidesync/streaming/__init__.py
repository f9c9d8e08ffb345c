"""Structured Streaming front for repeated increments."""
