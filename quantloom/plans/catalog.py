"""All registered queries of the market-data operators."""

from __future__ import annotations

from . import queries_bars, queries_daily, queries_options, queries_sources  # noqa: F401  they register their queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
