"""Operators for training-data pipelines: ten operators on documents, pages and benchmark items."""
