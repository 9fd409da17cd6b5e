"""Metrics kept as mergeable states per day, of which a refresh recomputes the periods that changed.

Two tables: the states, partitioned by period (days, or months where a day is too little for a file), and a
fingerprint per period. A refresh takes the fingerprints of the source, one pre-aggregated pass over it, compares
them with those stored, computes the states of the periods that differ, and overwrites these partitions only. Periods
without a change keep their files. Reports merge the states (:mod:`rosterloom.operators.bitmaps`), so months
and quarters come from days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterloom.sources.ingest import drop_days, overwrite_days, replace_table

MANY = 366  # up to so many, periods are named in the query, so that the scan can skip files


@dataclass(frozen=True)
class DailyStates:
    """What a refresh needs to know.

    ``build`` makes states from the facts of some periods; the result has the day column ``day``. ``date_column`` dates the facts;
    undated facts are in no state. ``unit`` is ``DD``, ``MM`` or ``YYYY``. ``depends_on`` are other inputs whose change makes all
    states stale.
    """

    build: Callable[[DataFrame], DataFrame]
    date_column: str
    day: str
    table: str
    depends_on: tuple[DataFrame, ...] = ()
    unit: str = "DD"


PERIOD = "state_period"


def _period(column: str, unit: str) -> Column:
    day = F.col(column).cast("date")
    return day if unit == "DD" else F.trunc(day, unit)


def fingerprints(facts: DataFrame, date_column: str, unit: str = "DD", salt: int = 0) -> DataFrame:
    """``period, rows, total, mixed`` per period: the number of rows and order-free sums of two hashes of each.

    Repeated rows count, so that a row that comes twice differs from one that comes once.
    """
    row = F.xxhash64(F.lit(salt), *(F.col(f"`{c}`") for c in facts.columns))
    part = facts.where(F.col(date_column).isNotNull()).select(
        _period(date_column, unit).alias(PERIOD), row.alias("h"), F.xxhash64(row, F.lit("second")).alias("g"))
    return part.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(20,0)")).cast("string").alias("total"),
                                   F.sum(F.col("g").cast("decimal(20,0)")).cast("string").alias("mixed"))


def _salt(frames: tuple[DataFrame, ...]) -> int:
    """One number for the rows of the frames."""
    salt = 0
    for frame in frames:
        row = F.xxhash64(*(F.col(f"`{c}`") for c in frame.columns))
        n, total = frame.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(20,0)")).cast("string")).first()
        salt = hash((salt, n, int(total or 0))) % (1 << 62)
    return salt


def refresh(spark: SparkSession, facts: DataFrame, plan: DailyStates) -> list[dt.date]:
    """Brings the states up to date; returns the periods that were computed (their first days), in order.

    Periods that the facts no longer have lose their partition. What comes to the driver is one row per changed period. A refresh
    that fails before its end leaves the old fingerprints, so that the next one computes the same periods again.
    """
    marks = f"{plan.table}__marks"
    columns = f"{PERIOD} date, rows long, total string, mixed string"
    known = spark.table(marks) if spark.catalog.tableExists(marks) else spark.createDataFrame([], columns)
    now = fingerprints(facts, plan.date_column, plan.unit, _salt(plan.depends_on))
    fields = ["rows", "total", "mixed"]
    old = known.select(PERIOD, F.struct(*fields).alias("old"))
    moved = now.select(PERIOD, F.struct(*fields).alias("new")).join(old, PERIOD, "full").where(
        ~F.col("new").eqNullSafe(F.col("old"))).select(PERIOD, "new.*", F.col("new").isNull().alias("gone")).collect()
    gone = sorted(r[PERIOD] for r in moved if r["gone"])
    changed = sorted(r[PERIOD] for r in moved if not r["gone"])
    if changed:
        overwrite_days(plan.build(_some(facts, plan, changed)).withColumn(PERIOD, _period(plan.day, plan.unit)), plan.table, PERIOD)
    drop_days(spark, plan.table, PERIOD, gone)
    if moved:
        # The fingerprints come last, so that an interrupted refresh is repeated.
        kept = {tuple(r) for r in known.collect() if r[PERIOD] not in {m[PERIOD] for m in moved}}
        kept |= {tuple(r)[:4] for r in moved if not r["gone"]}
        replace_table(spark.createDataFrame(sorted(kept), columns).coalesce(1), marks)
    return changed


def _some(facts: DataFrame, plan: DailyStates, changed: list[dt.date]) -> DataFrame:
    """The facts of the changed periods: a range on the column itself, which reaches the files' statistics, then the periods."""
    day, after = F.col(plan.date_column), {"DD": dt.timedelta(days=1), "MM": dt.timedelta(days=31), "YYYY": dt.timedelta(days=366)}
    first, end = changed[0], changed[-1] + after[plan.unit]
    if day_is_timestamp(facts, plan.date_column):
        first, end = dt.datetime.combine(first, dt.time()), dt.datetime.combine(end, dt.time())
    some = facts.where((day >= F.lit(first)) & (day < F.lit(end)))
    if len(changed) <= MANY:
        return some.where(_period(plan.date_column, plan.unit).isin(changed))
    listed = facts.sparkSession.createDataFrame([(d,) for d in changed], f"{PERIOD} date")
    return some.withColumn(PERIOD, _period(plan.date_column, plan.unit)).join(listed, PERIOD, "left_semi").drop(PERIOD)


def day_is_timestamp(frame: DataFrame, column: str) -> bool:
    return frame.schema[column].dataType.typeName().startswith("timestamp")
