"""Optional filters of the parameterised reports."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F


def equals_where_given(**wanted: object) -> list[Column]:
    """One equality per argument that is not None; values become typed literals."""
    return [F.col(name) == F.lit(value) for name, value in wanted.items() if value is not None]


def keep(frame: DataFrame, predicates: Iterable[Column]) -> DataFrame:
    """Rows satisfying all predicates, as one conjunction Catalyst can push down."""
    predicates = list(predicates)
    return frame.where(reduce(and_, predicates)) if predicates else frame
