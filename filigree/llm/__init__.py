"""Operators for large-scale text data; nothing outside this package imports them."""
