"""Catalog, manifest, property and state readers and writers."""
