"""Registered queries: every operator on the given tables, with its SQL twin."""

from hydrolake.plans.registry import ORACLE_SQL, QUERIES, load_all

__all__ = ["ORACLE_SQL", "QUERIES", "load_all"]
