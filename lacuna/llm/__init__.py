"""Operators for training-data pipelines: text extraction, filters, dedup, tokens, models."""
