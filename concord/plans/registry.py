"""All queries of the reconciliation part, by name, with the SQL that gives the same rows."""

from __future__ import annotations

from concord.plans import entity_queries, event_queries, flow_queries, keyed_queries, shape_queries, source_queries, stream_queries, write_queries  # noqa: F401  (they register themselves)
from concord.plans.entry import ORACLE_SQL, QUERIES
from concord.plans.flow_queries import flagship

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
