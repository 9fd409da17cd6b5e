"""Reusable relational steps: the workforce join, row copies, filters, top-k."""

from rosterloom.operators.filters import equals_where_given, keep
from rosterloom.operators.ranking import top_k, top_k_of_many, top_k_per_group
from rosterloom.operators.workforce import (
    expand_copies,
    join_bucketed,
    join_split,
    join_workforce,
    latest_workforce,
    weighted_sum,
    workforce_dimension,
)

__all__ = [
    "equals_where_given", "expand_copies", "join_bucketed", "join_split", "join_workforce", "keep",
    "latest_workforce", "top_k",
    "top_k_of_many", "top_k_per_group", "weighted_sum",
    "workforce_dimension",
]
