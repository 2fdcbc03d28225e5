"""Operators for preparing training text: tokens, quality, duplicates, packing, toxicity, archives."""
