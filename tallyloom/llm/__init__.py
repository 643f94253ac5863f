"""Operators of a training-data pipeline: tokenizers, filters, deduplication and models."""
