"""Incremental feed."""
