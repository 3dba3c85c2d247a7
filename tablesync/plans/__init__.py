"""Batches: many tables or views driven by a manifest and a state table."""
