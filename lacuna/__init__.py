"""Sparse NDJSON analytics as PySpark DataFrame operators."""
