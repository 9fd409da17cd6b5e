"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def quoted(name: str) -> Column:
    """Column by its literal name: raw names hold spaces and brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def trimmed(name: str) -> Column:
    """Strips spaces only; tabs and line breaks stay."""
    return F.trim(quoted(name))


def full_name(first: Column | str = "first_name", last: Column | str = "last_name") -> Column:
    """Null when either part is null, unlike ``concat_ws``."""
    return F.concat(first, F.lit(" "), last)


def contains_pattern(text: str) -> str:
    """LIKE pattern for a search box: ``%`` and ``_`` keep their wildcard meaning,
    a backslash stands for itself (Spark would take it as the escape sign)."""
    return "%" + text.replace("\\", "\\\\") + "%"
