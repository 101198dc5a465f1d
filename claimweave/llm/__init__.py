"""Operators for preparing training corpora: filters, near duplicates, scores, archives, tokens."""
