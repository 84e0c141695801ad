"""Operators for building training corpora, and their queries."""

from .registry import CHECK_SQL, QUERIES

__all__ = ["CHECK_SQL", "QUERIES"]
