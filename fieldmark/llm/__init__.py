"""Operators for large collections of text, pages and vectors, used to prepare training data."""
