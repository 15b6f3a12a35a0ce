"""Queries over the driver's tables, by name, and the SQL that gives the same rows."""

from . import health, more, quotes, series, streams, terms, text, vectors  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
