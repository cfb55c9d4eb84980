"""Queries over the sample tables, each with its plain-SQL twin."""

from . import audit, cleaning, costs, dims, factors, grids, loads, quality, series  # noqa: F401
from .registry import QUERIES

__all__ = ["QUERIES"]
