"""The registered queries over the given tables."""

from . import q_marts, q_reports, q_runs, q_tables  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
