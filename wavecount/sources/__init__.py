"""Readers, parsers and writers of text lines."""
