"""Operators for preparing training data: filters, dedup, decontamination, scoring, extraction, sharding, tokens."""
