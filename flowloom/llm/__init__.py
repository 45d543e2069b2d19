"""Operators for training-data text and for matching records; nothing else in the library imports this package."""
