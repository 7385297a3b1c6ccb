"""Micro-batch wrappers."""
