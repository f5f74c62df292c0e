"""Operators for training data: deduplication, quality, mixing, licences, personal data and tokens."""
