"""Operators that prepare training data: filters, deduplication, search, packing."""
