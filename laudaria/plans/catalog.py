"""Every query of the core library with the SQL it is held against."""

from __future__ import annotations

from laudaria.plans import q_io, q_relational, q_reports, q_values  # noqa: F401
from laudaria.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
