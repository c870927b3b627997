"""Streaming forms of the catalog operators."""
