"""All queries and their SQL."""

from . import model_queries, profile_queries, score_queries, snapshot_queries  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
