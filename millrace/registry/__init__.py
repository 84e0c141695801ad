"""Named queries on the given tables, each with its checking SQL."""

from . import storage, taxi, terms, texts, trend  # noqa: F401
from .base import CHECK_SQL, QUERIES

__all__ = ["CHECK_SQL", "QUERIES"]
