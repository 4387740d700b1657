"""Incremental arrival of landed rate files."""
