"""Readers, seeds and writers."""
