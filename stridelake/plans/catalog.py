"""All registered queries of the motion operators, with their oracle SQL."""

from __future__ import annotations

from stridelake.plans.register import ORACLE_SQL, QUERIES  # noqa: F401
from stridelake.plans import range_queries, window_queries, geometry_queries, join_queries, aggregate_queries, record_queries, signal_queries, step_queries, guard_queries, model_queries  # noqa: E402,F401,I001
