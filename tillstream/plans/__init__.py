"""Whole queries: the batch pipelines, and the catalogue run against the given tables."""
