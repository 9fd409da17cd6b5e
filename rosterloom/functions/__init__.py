"""Column expressions shared by every view.

All of them are built from Spark's own functions, so they stay inside
whole-stage code generation; there is no Python UDF in the library.
"""

from rosterloom.functions.aggregates import distinct_count, exact_mean, row_count
from rosterloom.functions.dates import (
    day_name,
    day_of_week,
    iso_week,
    month_of,
    month_text,
    months_before,
    parse_date,
    quarter_of,
    year_of,
    years_between,
)
from rosterloom.functions.numbers import (
    as_integer,
    guarded_ratio,
    hours,
    nullable_ratio,
    round_to,
    zero_if_null,
)
from rosterloom.functions.ordering import ascending, descending
from rosterloom.functions.text import contains_pattern, full_name, quoted, trimmed

__all__ = [
    "as_integer", "ascending", "contains_pattern", "day_name", "day_of_week",
    "descending", "distinct_count", "exact_mean", "full_name", "guarded_ratio",
    "hours", "iso_week", "month_of", "month_text", "months_before",
    "nullable_ratio", "parse_date", "quarter_of", "quoted", "round_to",
    "row_count", "trimmed", "year_of", "years_between", "zero_if_null",
]
