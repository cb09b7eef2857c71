"""Operators for training-data pipelines; nothing else in sheaf imports them."""
