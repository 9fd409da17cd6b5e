"""Refreshes of daily states, and imports of a window: what is rewritten, and what the tables then hold."""

import datetime as dt
import os
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rosterloom.operators import bitmaps
from rosterloom.operators.bitmaps import Measures
from rosterloom.sources import incremental, ingest
from rosterloom.sources.scratch import fresh_database

DAY = dt.date(2024, 3, 1)


def measures():
    return Measures(counts={"people": ("person", None), "late": ("person", "minutes > 60")}, sums={"minutes": F.col("minutes")})


def facts_of(spark, rows):
    return spark.createDataFrame([(DAY + dt.timedelta(days=d) if d is not None else None, p, m) for d, p, m in rows],
                                 "day date, person long, minutes long")


def plan_of(database, depends_on=()):
    return incremental.DailyStates(lambda f: bitmaps.states(f, ["day"], measures()), "day", "day", f"{database}.states", depends_on)


def totals(spark, database):
    return {(r["day"] - DAY).days: (r["people"], r["late"], r["minutes"]) for r in
            bitmaps.counted(spark.table(f"{database}.states"), ["day"], measures()).collect()}


def files(spark, table):
    """(name, time) of the data files of each partition."""
    folder = Path(spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()[1].removeprefix("file:"))
    out = {}
    for path in folder.glob("*/*.parquet"):
        out.setdefault(path.parent.name, set()).add((path.name, os.stat(path).st_mtime_ns))
    return out


ROWS = [(d, p, 10 * p) for d in range(5) for p in range(1, 9)] + [(None, 1, 5)]


def test_only_changed_days_are_rewritten(spark):
    database = fresh_database(spark, "inc_changed")
    assert incremental.refresh(spark, facts_of(spark, ROWS), plan_of(database)) == [DAY + dt.timedelta(days=d) for d in range(5)]
    first = files(spark, f"{database}.states")
    # Nothing new: nothing is computed or written.
    assert incremental.refresh(spark, facts_of(spark, ROWS).repartition(7), plan_of(database)) == []
    assert files(spark, f"{database}.states") == first
    changed = [(d, p, m + (d == 2 and p == 3)) for d, p, m in ROWS] + [(9, 1, 100)]
    assert incremental.refresh(spark, facts_of(spark, changed), plan_of(database)) == [
        DAY + dt.timedelta(days=2), DAY + dt.timedelta(days=9)]
    second = files(spark, f"{database}.states")
    assert {k for k in second if second[k] != first.get(k)} == {"state_period=2024-03-03", "state_period=2024-03-10"}
    whole = fresh_database(spark, "inc_whole")
    incremental.refresh(spark, facts_of(spark, changed), plan_of(whole))
    assert totals(spark, database) == totals(spark, whole) and totals(spark, database)[2] == (8, 2, 361)


def test_a_repeated_row_and_a_vanished_day_are_changes(spark):
    database = fresh_database(spark, "inc_gone")
    incremental.refresh(spark, facts_of(spark, ROWS), plan_of(database))
    rows = [r for r in ROWS if r[0] != 4] + [(0, 1, 10)]
    assert incremental.refresh(spark, facts_of(spark, rows), plan_of(database)) == [DAY]
    assert totals(spark, database) == {0: (8, 2, 370), 1: (8, 2, 360), 2: (8, 2, 360), 3: (8, 2, 360)}
    assert incremental.refresh(spark, facts_of(spark, rows), plan_of(database)) == []


def test_another_input_makes_all_days_stale(spark):
    database = fresh_database(spark, "inc_other")
    for names, days in (("a", 5), ("a", 0), ("b", 5)):
        other = spark.createDataFrame([(names,)], "name string")
        assert len(incremental.refresh(spark, facts_of(spark, ROWS), plan_of(database, (other,)))) == days


def test_an_interrupted_refresh_is_repeated(spark):
    database = fresh_database(spark, "inc_failed")
    plan = plan_of(database)
    broken = incremental.DailyStates(lambda f: plan.build(f.withColumn("minutes", F.raise_error(F.lit("stop")).cast("long"))),
                                     "day", "day", plan.table)
    with pytest.raises(Exception, match="stop"):
        incremental.refresh(spark, facts_of(spark, ROWS), broken)
    assert len(incremental.refresh(spark, facts_of(spark, ROWS), plan)) == 5
    assert len(totals(spark, database)) == 5


def test_more_changed_days_than_are_named(spark, monkeypatch):
    monkeypatch.setattr(incremental, "MANY", 2)
    database = fresh_database(spark, "inc_many")
    assert len(incremental.refresh(spark, facts_of(spark, ROWS), plan_of(database))) == 5
    assert totals(spark, database) == {d: (8, 2, 360) for d in range(5)}


def test_months_and_an_empty_source(spark):
    database = fresh_database(spark, "inc_months")
    rows = [(d, 1, 1) for d in range(400)]
    plan = replace(plan_of(database), unit="MM")
    assert len(incremental.refresh(spark, facts_of(spark, rows), plan)) == 14
    assert len(totals(spark, database)) == 400
    later = [(d, 1, 1 + (d == 390)) for d in range(395)]
    assert incremental.refresh(spark, facts_of(spark, later), plan) == [dt.date(2025, 3, 1)]
    assert len(totals(spark, database)) == 395 and totals(spark, database)[390] == (1, 0, 2)
    assert incremental.refresh(spark, facts_of(spark, []), plan) == []
    assert totals(spark, database) == {}


def log_of(spark, rows):
    return spark.createDataFrame([(dt.datetime(2024, 3, d, h) if d else None, x) for d, h, x in rows], "at timestamp, x int")


def test_a_window_import_keeps_older_days_and_is_never_missing(spark):
    table = f"{fresh_database(spark, 'window')}.log"
    source = log_of(spark, [(1, 9, 1), (10, 9, 2), (10, 1, 3), (12, 9, 4), (0, 0, 5)])
    ingest.import_days(source, table, "at", 30, dt.datetime(2024, 3, 12, 15))
    first = files(spark, table)
    later = log_of(spark, [(10, 9, 20), (10, 1, 30), (13, 9, 6), (1, 9, 99)])  # day 12 is gone, day 1 before the window
    ingest.import_days(later, table, "at", 3, dt.datetime(2024, 3, 13, 15))
    # The window begins with the whole 10th, though three days back from the afternoon is later.
    assert sorted(r["x"] for r in spark.table(table).collect()) == [1, 6, 20, 30]
    second = files(spark, table)
    assert second["import_day=2024-03-01"] == first["import_day=2024-03-01"]
    ingest.import_days(log_of(spark, []), table, "at", 3, dt.datetime(2024, 3, 13, 15))
    assert [r["x"] for r in spark.table(table).collect()] == [1]
