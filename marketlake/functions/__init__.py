"""Scalar expressions: tolerant casts, keys, dates."""
