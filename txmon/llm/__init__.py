"""Operators for preparing training data: filtering, deduplication, tokens, packing."""
