"""Operators for preparing training text: token shards, deduplication, decontamination, scoring, formatting."""
