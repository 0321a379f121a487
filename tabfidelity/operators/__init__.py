"""Relational operators over a seed and a synthetic table."""
