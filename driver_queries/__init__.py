"""Queries over the given tables, one per operator, each with its SQL for DuckDB."""

from driver_queries import basics, history, rules, star, star_airline  # noqa: F401
from driver_queries.registry import ORACLES, QUERIES  # noqa: F401
