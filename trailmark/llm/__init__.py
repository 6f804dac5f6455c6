"""Operators for training data: scans, filters, deduplication, search and tokenization over whole corpora."""
