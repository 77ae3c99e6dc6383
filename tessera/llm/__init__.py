"""Operators for large-scale training-data pipelines (see the README)."""
