"""Operators that the DataFrame API lacks, composed from those it has."""

from weft.operators.joins import as_of_join, interval_join, range_join, salted_join, sized_join
from weft.operators.ranking import group_percentiles, latest_per_key, top_k
from weft.operators.sessions import sessionize
from weft.operators.vectors import cosine_top_k

__all__ = ["as_of_join", "cosine_top_k", "group_percentiles", "interval_join", "latest_per_key", "range_join", "salted_join", "sessionize", "sized_join", "top_k"]
