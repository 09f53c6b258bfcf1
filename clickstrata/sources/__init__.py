"""Readers and text parsers."""
