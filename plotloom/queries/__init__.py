"""Queries over the driver tables, each with the SQL it must agree with."""

from plotloom.queries import columns, growth, keys, loads, reshape, sheets, sinks, stats  # noqa: F401
from plotloom.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
