"""Corpus operators for training-data pipelines (self-contained subpackage)."""
