"""All registered queries."""

from __future__ import annotations

from chronoloom.plans import (  # noqa: F401 - importing registers the queries
    q_clean,
    q_forecast,
    q_inspect,
    q_learn,
    q_search,
    q_sources,
    q_split,
    q_stream,
)
from chronoloom.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
