"""All registered queries."""

from __future__ import annotations

from . import queries_align, queries_cleaning, queries_corrections, queries_grid, queries_profiles, queries_publish, queries_qc, queries_reports, queries_segments, queries_sources  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
