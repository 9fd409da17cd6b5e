"""Data-quality checks: single ones, each a one-row frame of the same columns, and all checks of some tables at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from rosterloom.functions import quoted, row_count


def _result(counted: DataFrame, check: str, table: str, failures: Column, noun: str,
            now: dt.datetime | None) -> DataFrame:
    moment = F.current_timestamp() if now is None else F.lit(now)
    return counted.select(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
        moment.alias("check_time"), (failures == 0).alias("passed"),
        F.concat(failures.cast("string"), F.lit(f" {noun}")).alias("details"))


def not_null(frame: DataFrame, table: str, columns: Sequence[str],
             now: dt.datetime | None = None) -> DataFrame:
    """Null counts of all columns in one pass; one row per column."""
    counted = frame.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    unpivoted = counted.unpivot([], list(columns), "column", "nulls")
    moment = F.current_timestamp() if now is None else F.lit(now)
    return unpivoted.select(
        F.concat(F.lit("not_null:"), F.col("column")).alias("check_name"),
        F.lit(table).alias("table_name"), moment.alias("check_time"),
        (F.col("nulls") == 0).alias("passed"),
        F.concat(F.col("nulls").cast("string"), F.lit(" null values")).alias("details"))


def unique(frame: DataFrame, table: str, key: Sequence[str],
           now: dt.datetime | None = None) -> DataFrame:
    """Keys occurring more than once; rows with a null in the key are left out."""
    present = reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in key))
    repeated = (frame.where(present).groupBy(*key).agg(row_count().alias("copies"))
                .agg(F.count_if(F.col("copies") > 1).alias("failures")))
    return _result(repeated, f"unique:{','.join(key)}", table, F.col("failures"),
                   "repeated keys", now)


def referential(frame: DataFrame, table: str, column: str, parent: DataFrame,
                parent_column: str, now: dt.datetime | None = None) -> DataFrame:
    """Distinct values without a parent.

    Both sides are reduced to distinct values before they are joined, so a value
    carried by most rows is one row of the join.
    """
    values = frame.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    known = (parent.where(F.col(parent_column).isNotNull())
             .select(F.col(parent_column).alias("value")).distinct())
    orphans = values.join(known, "value", "left_anti").agg(row_count().alias("failures"))
    return _result(orphans, f"referential:{column}", table, F.col("failures"),
                   "values without a parent", now)


def same_row_count(frame: DataFrame, table: str, other: DataFrame,
                   now: dt.datetime | None = None) -> DataFrame:
    sides = frame.select(F.lit(1).alias("sign")).unionByName(other.select(F.lit(-1).alias("sign")))
    gap = sides.agg(F.abs(F.coalesce(F.sum("sign"), F.lit(0))).alias("failures"))
    return _result(gap, "same_row_count", table, F.col("failures"), "rows difference", now)


def report(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


@dataclass(frozen=True)
class TableChecks:
    """What is expected of one table.

    ``unique`` lists keys, each some columns; ``referential`` lists (column, parent table, parent column), and ``same_rows`` tables
    of as many rows. Parents are named as in the mapping given to :func:`checked`.
    """

    frame: DataFrame
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    referential: tuple[tuple[str, str, str], ...] = ()
    same_rows: tuple[str, ...] = ()


_ENTRY = "array<struct<what:string,side:int,key:array<string>>>"


def _text(name: str) -> Column:
    return quoted(name).cast("string")


def _entry(what: str, side: int, *names: str) -> Column:
    key = F.array(*(_text(name) for name in names)) if names else F.array().cast("array<string>")
    entry = F.struct(F.lit(what).alias("what"), F.lit(side).alias("side"), key.alias("key"))
    missing = reduce(lambda a, b: a | b, (quoted(name).isNull() for name in names), F.lit(False))
    return F.when(~missing, entry)


def checked(tables: Mapping[str, TableChecks], now: dt.datetime | None = None) -> DataFrame:
    """One row per check, as the single functions give, from one scan of each table.

    A row becomes one entry per thing it takes part in: its table's row count, each null, each unique key, each value that
    needs a parent, each value that is one. Entries are counted by (thing, key), on the map side first, so a value that most rows
    carry is a few partial counts; then by thing. Keys with a null are left out. Keys are compared as text, so a column and its
    parent must have one type, or be whole numbers both (:class:`ValueError`).
    """
    scans, wanted = [], []
    for name, expected in tables.items():
        entries = [_entry(f"rows:{name}", 0)]
        for column in expected.not_null:
            what = f"null:{name}:{column}"
            entries.append(F.when(quoted(column).isNull(), _entry(what, 0)))
            wanted.append((f"not_null:{column}", name, what, None, "null values"))
        for key in expected.unique:
            what = f"unique:{name}:{','.join(key)}"
            entries.append(_entry(what, 0, *key))
            wanted.append((f"unique:{','.join(key)}", name, what, None, "repeated keys"))
        for column, parent, _ in expected.referential:
            what = f"child:{name}:{column}:{parent}"
            entries.append(_entry(what, 0, column))
            wanted.append((f"referential:{column}", name, what, None, "values without a parent"))
        for other in expected.same_rows:
            wanted.append(("same_row_count", name, f"rows:{name}", f"rows:{other}", "rows difference"))
        for child, other in tables.items():
            for column, parent, parent_column in other.referential:
                if parent == name:
                    _one_type(other.frame, column, expected.frame, parent_column)
                    entries.append(_entry(f"child:{child}:{column}:{parent}", 1, parent_column))
        listed = F.filter(F.array(*entries), lambda e: e.isNotNull()).cast(_ENTRY)
        scans.append(expected.frame.select(F.inline(listed)))
    unknown = {p for t in tables.values() for p in [*(r[1] for r in t.referential), *t.same_rows]} - set(tables)
    if unknown:
        raise ValueError(f"no such tables: {sorted(unknown)}")
    keyed = reduce(DataFrame.unionByName, scans).groupBy("what", "key").agg(
        F.count_if(F.col("side") == 0).alias("children"), F.count_if(F.col("side") == 1).alias("parents"))
    kind = F.substring_index("what", ":", 1)
    failed = (F.when(kind == "unique", (F.col("children") > 1).cast("long"))
              .when(kind == "child", ((F.col("children") > 0) & (F.col("parents") == 0)).cast("long")).otherwise(F.col("children")))
    counts = keyed.groupBy("what").agg(F.sum(failed).alias("failures"))
    # One row of a few numbers: a check that met no entry has no failure.
    found = counts.agg(F.map_from_entries(F.collect_list(F.struct("what", "failures"))).alias("n"))
    number = {w: F.coalesce(F.col("n")[w], F.lit(0)) for _, _, *both, _ in wanted for w in both if w}
    moment = F.current_timestamp() if now is None else F.lit(now)
    rows = [F.struct(F.lit(check).alias("check_name"), F.lit(name).alias("table_name"),
                     (F.abs(number[what] - number[other]) if other else number[what]).alias("failures"), F.lit(noun).alias("noun"))
            for check, name, what, other, noun in wanted]
    return found.select(F.inline(F.array(*rows))).select(
        "check_name", "table_name", moment.alias("check_time"), (F.col("failures") == 0).alias("passed"),
        F.concat(F.col("failures").cast("string"), F.lit(" "), "noun").alias("details"))


def _one_type(frame: DataFrame, column: str, parent: DataFrame, parent_column: str) -> None:
    ours, theirs = frame.schema[column].dataType, parent.schema[parent_column].dataType
    if ours != theirs and not (isinstance(ours, IntegralType) and isinstance(theirs, IntegralType)):
        raise ValueError(f"{column} and {parent_column} are of different types: {ours.simpleString()}, {theirs.simpleString()}")
