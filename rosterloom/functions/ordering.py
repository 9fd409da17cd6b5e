"""Sort keys: nulls last in both directions, as the source dialect has it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ascending(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def descending(*names: str) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in names]
