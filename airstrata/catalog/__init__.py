"""Queries over the driver's tables, each with the SQL that must agree with it."""

from . import documents, features, layers, rows, stores, text  # noqa: F401  (fill the registry)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
