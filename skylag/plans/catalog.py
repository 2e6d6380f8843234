"""All checked queries, by importing the modules that register them."""

from skylag.plans import queries_batch, queries_ml, queries_sources, queries_streams  # noqa: F401
from skylag.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
