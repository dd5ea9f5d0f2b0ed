"""Readers, writers and archive queries."""
