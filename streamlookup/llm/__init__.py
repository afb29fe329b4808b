"""Operators for preparing training data: scoring, filtering, deduplicating, tokenising and packing documents."""
