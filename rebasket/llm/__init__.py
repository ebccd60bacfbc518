"""Operators for building training corpora: scoring, deduplication, archives, tokens, mixing."""
