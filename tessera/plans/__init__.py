"""Registered query plans over the test tables (``QUERIES``) and their DuckDB oracle SQL (``ORACLES``)."""

from . import blocks, files, graph, retrieval, sections, tables, typed, vectors  # noqa: F401  (registers plans)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
