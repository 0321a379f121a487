"""Scalar column functions and hash-based randomness."""
