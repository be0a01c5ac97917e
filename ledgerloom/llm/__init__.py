"""Operators for preparing training text: tokenizers, duplicates, search, toxicity, packing."""
