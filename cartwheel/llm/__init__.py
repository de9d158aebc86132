"""Operators for preparing training text: scans, deduplication, scoring, tokens, shards."""
