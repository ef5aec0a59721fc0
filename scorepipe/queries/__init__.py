"""Registered queries: each operator over the given tables, next to the SQL that must give the same rows."""

from scorepipe.queries import etl, evaluation, explanation, modelling, profiling, risk, sampling  # noqa: F401
from scorepipe.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
