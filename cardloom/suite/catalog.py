"""All registered queries."""

from __future__ import annotations

from cardloom.suite import learned, loading, maintained, relational, streams  # noqa: F401
from cardloom.suite.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
