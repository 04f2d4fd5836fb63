"""Operators for preparing training data: filters, deduplication, tokens and chat text."""
