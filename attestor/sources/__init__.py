"""Readers of registries, documents, links and releases."""
