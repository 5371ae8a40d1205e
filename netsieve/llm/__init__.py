"""Operators of a training-data pipeline (documents, benchmark, labels tables)."""
