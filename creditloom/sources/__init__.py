"""Readers, writers, schema contracts and artifact listings."""
