"""Registered queries: each operator run on the driver tables, with its SQL check."""

from .registry import ORACLES, QUERIES
from . import segments, scans, scalars, relational, reporting, models  # noqa: F401  (register)

__all__ = ["ORACLES", "QUERIES"]
