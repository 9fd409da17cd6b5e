"""Band labels and limits.

Fixed values: the labels and limits below are part of the views' contract; each
band holds the values under its limit that no earlier band took.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNKNOWN = "Unknown"
TENURE_BANDS = (("< 1 Year", 1), ("1-2 Years", 3), ("3-4 Years", 5), ("5-9 Years", 10),
                ("10-19 Years", 20), ("20+ Years", None))
AGE_BANDS = (("Under 25", 25), ("25-34", 35), ("35-44", 45), ("45-54", 55), ("55-64", 65),
             ("65+", None))
SPAN_BANDS = (("Individual Contributor", 1), ("Small Team (1-5)", 6), ("Medium Team (6-10)", 11),
              ("Large Team (11-20)", 21), ("Very Large Team (20+)", None))


def band(value: Column, bands: tuple[tuple[str, int | None], ...]) -> Column:
    chosen = F.when(value.isNull(), UNKNOWN)
    for label, limit in bands:
        chosen = chosen.otherwise(label) if limit is None else chosen.when(value < limit, label)
    return chosen


def band_position(label: Column, bands: tuple[tuple[str, int | None], ...]) -> Column:
    """1-based position for sorting; a label outside the bands comes last."""
    position = F.array_position(F.array(*(F.lit(name) for name, _ in bands)), label)
    return F.when(position > 0, position).otherwise(len(bands) + 1)
