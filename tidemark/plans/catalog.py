"""All queries: importing the modules registers them."""

from tidemark.plans import facts, features, lookups, models, monitoring, sources, streams  # noqa: F401
from tidemark.plans.binding import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
