"""All named queries."""

from . import q_checks, q_cleaning, q_functions, q_log, q_operators  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
