"""Operators on training data: filtering, deduplication, scoring, tokenisation, search and packing."""
