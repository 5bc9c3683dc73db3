"""Operators for building training data: filters, tokenizers, duplicates, packing."""
