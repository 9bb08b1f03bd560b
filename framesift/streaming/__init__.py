"""Structured Streaming forms of the capture and live operators."""
