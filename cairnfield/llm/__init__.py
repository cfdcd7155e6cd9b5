"""Operators for training data and language: addresses, names, sources, tokens and text forms."""
