"""Operators that prepare training data: fingerprints, search, filters, deduplication, tokens and packing."""
