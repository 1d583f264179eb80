"""The registered queries, each next to the SQL that states its result independently."""

from catalogue import checks, cleaning, columns, drift, rows, scans  # noqa: F401
from catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
