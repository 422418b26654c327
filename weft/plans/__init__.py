"""Registered queries: name -> (query, SQL for DuckDB or None)."""

from weft.plans.events import EVENT_QUERIES
from weft.plans.relational import RELATIONAL_QUERIES

QUERIES = {**RELATIONAL_QUERIES, **EVENT_QUERIES}
