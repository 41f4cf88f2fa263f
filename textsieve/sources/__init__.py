"""Readers and writers of line-delimited JSON."""
