"""Operators for building training data: filtering, deduplication, formatting, tokens and packing."""
