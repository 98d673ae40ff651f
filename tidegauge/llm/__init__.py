"""Operators for training-data pipelines over whole corpora."""
