"""Incremental form of the landing step."""
