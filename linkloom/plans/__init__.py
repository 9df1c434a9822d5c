"""Registered queries: the operators bound to the stored tables, each with its SQL."""

from linkloom.plans import links, search, sessions, streams, tables  # noqa: F401
from linkloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
