"""Operators for building training data out of very large text tables."""
