"""Registered queries and their DuckDB counterparts."""

from __future__ import annotations

from . import (aggregates, checks, joins, maintenance, projections, rows, scalars, scans,  # noqa: F401
               streams)
from ._registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
