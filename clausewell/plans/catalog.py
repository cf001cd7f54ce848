"""All registered queries of the retrieval engine and their oracle SQL."""

from __future__ import annotations

from clausewell.plans import evaluation_queries, parsing_queries, retrieval_queries  # noqa: F401  they register
from clausewell.plans.registry import ORACLES, QUERIES

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
FLAGSHIP = "retrieve_full"
