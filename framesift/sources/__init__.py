"""Readers: documents, listings and text files as tables."""
