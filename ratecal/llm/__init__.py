"""Operators for preparing training text: filters, near-duplicates, extraction, tokens, models."""
