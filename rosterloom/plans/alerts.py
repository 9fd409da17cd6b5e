"""Executive alerts: five rules, each producing the same columns.

The three attendance rules need the last 30 days joined to the master.  The 30
days are reduced to one row per employee before that join, and one pass over
the joined rows (grouping sets by person and by department) feeds all three.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from rosterloom.functions import ascending, full_name, row_count
from rosterloom.operators import join_workforce, weighted_sum, workforce_dimension
from rosterloom.operators.workforce import Grain

# Rule thresholds.
ARREARS_LIMIT = 500
LATE_ARRIVALS_LIMIT = 5
ABSENCE_PERCENT_LIMIT = 10
OVERTIME_HOURS_LIMIT = 20
ATTENDANCE_DAYS = 30
TERMINATION_DAYS = 7
# Priorities, most urgent first.
PRIORITIES = ("High", "Medium", "Low")

COLUMNS = ("alert_type", "priority", "employee_id", "employee_name", "description",
           "metric_value", "detail")


def _alert(alert_type: str, priority: str, employee_id: Column, name: Column,
           description: str, value: Column, detail: Column) -> Column:
    parts = (F.lit(alert_type), F.lit(priority), employee_id.cast("string"), name,
             F.lit(description), value, detail)
    return F.struct(*(part.alias(column) for part, column in zip(parts, COLUMNS)))


def _alerts(frame: DataFrame, *alerts: Column) -> DataFrame:
    """One row per non-null alert of each input row."""
    if len(alerts) == 1:
        return frame.select(alerts[0].alias("alert")).select("alert.*")
    candidates = F.filter(F.array(*alerts), lambda alert: alert.isNotNull())
    return frame.select(F.inline(candidates))


def _one_decimal(value: Column) -> Column:
    # Through DECIMAL: a double's text switches to exponents for large values.
    return F.round(value.cast("decimal(38,6)"), 1).cast("string")


def high_arrears(payroll: DataFrame, limit: float = ARREARS_LIMIT) -> DataFrame:
    """One alert per benefits line, not per employee."""
    amount = F.col("current_arrears").cast("string")
    return _alerts(
        payroll.where(F.col("current_arrears") > limit),
        _alert("HIGH_ARREARS", "High", F.col("employee_id"),
               full_name(F.trim("first_name"), F.trim("last_name")),
               "Employee has high arrears balance", amount,
               F.concat(F.lit("Amount: $"),
                        F.round("current_arrears", 2).cast("string"))))


def recent_terminations(workforce: DataFrame, as_of: dt.date,
                        days: int = TERMINATION_DAYS) -> DataFrame:
    since = F.lit(as_of - dt.timedelta(days=days))
    day = F.col("status_date").cast("string")
    return _alerts(
        workforce.where((F.col("employee_status") == "Terminated")
                        & (F.col("status_date") >= since)),
        _alert("RECENT_TERMINATION", "Low", F.col("employee_id"), F.col("full_name"),
               "Employee recently terminated", day, F.concat(F.lit("Terminated on "), day)))


def _recent_attendance(daily: DataFrame, workforce: DataFrame, as_of: dt.date,
                       attributes: list[str], grain: Grain) -> DataFrame:
    """The window's totals, one row per employee, joined to the master."""
    since = F.lit(as_of - dt.timedelta(days=ATTENDANCE_DAYS))
    per_employee = (daily.where(F.col("attendance_date") >= since).groupBy("employee_int_id")
                    .agg(F.count_if("is_late").alias("late_rows"),
                         F.count_if("is_absent").alias("absent_rows"),
                         F.sum(F.greatest("ot_duration", F.lit(0))).alias("ot_minutes"),
                         row_count().alias("day_rows")))
    return join_workforce(per_employee, workforce_dimension(workforce, attributes, grain))


def _lateness_alert() -> Column:
    count = F.col("late_rows").cast("string")
    return F.when(
        F.col("late_rows") > LATE_ARRIVALS_LIMIT,
        _alert("CHRONIC_LATENESS", "Medium", F.col("employee_int_id"), F.col("full_name"),
               "Employee frequently late in last 30 days", count,
               F.concat(F.lit("Late "), count, F.lit(" times in 30 days"))))


def _overtime_alert() -> Column:
    worked = F.col("ot_minutes").cast("double") / F.lit(60.0)
    return F.when(
        worked > OVERTIME_HOURS_LIMIT,
        _alert("EXCESSIVE_OT", "Low", F.col("employee_int_id"), F.col("full_name"),
               "Employee has excessive overtime", _one_decimal(worked),
               F.concat(_one_decimal(worked), F.lit(" OT hours in 30 days"))))


def _absence_alert() -> Column:
    percent = F.try_divide(F.col("absent_rows") * F.lit(100.0), F.col("day_rows"))
    return F.when(
        percent > ABSENCE_PERCENT_LIMIT,
        _alert("DEPT_HIGH_ABSENCE", "Medium", F.col("department_name"),
               F.col("department_name"), "Department has high absence rate",
               _one_decimal(percent), F.concat(_one_decimal(percent), F.lit("% absence rate"))))


_SUMS = ("late_rows", "ot_minutes", "absent_rows", "day_rows")


def _per_person(daily: DataFrame, workforce: DataFrame, as_of: dt.date,
                grain: Grain) -> DataFrame:
    return (_recent_attendance(daily, workforce, as_of, ["full_name"], grain)
            .groupBy("employee_int_id", "full_name")
            .agg(*(weighted_sum(name).alias(name) for name in _SUMS)))


def chronic_lateness(daily: DataFrame, workforce: DataFrame, as_of: dt.date, *,
                     workforce_grain: Grain = "snapshot") -> DataFrame:
    people = _per_person(daily, workforce, as_of, workforce_grain)
    return _alerts(people.where(F.col("late_rows") > LATE_ARRIVALS_LIMIT), _lateness_alert())


def excessive_overtime(daily: DataFrame, workforce: DataFrame, as_of: dt.date, *,
                       workforce_grain: Grain = "snapshot") -> DataFrame:
    people = _per_person(daily, workforce, as_of, workforce_grain)
    return _alerts(people.where(F.col("ot_minutes") / F.lit(60.0) > OVERTIME_HOURS_LIMIT),
                   _overtime_alert())


def department_absence(daily: DataFrame, workforce: DataFrame, as_of: dt.date, *,
                       workforce_grain: Grain = "snapshot") -> DataFrame:
    departments = (
        _recent_attendance(daily, workforce, as_of, ["department_name"], workforce_grain)
        .where(F.col("department_name").isNotNull()).groupBy("department_name")
        .agg(*(weighted_sum(name).alias(name) for name in _SUMS)))
    percent = F.col("absent_rows") * F.lit(100.0) / F.col("day_rows")
    return _alerts(departments.where(percent > ABSENCE_PERCENT_LIMIT), _absence_alert())


def _attendance_alerts(daily: DataFrame, workforce: DataFrame, as_of: dt.date,
                       grain: Grain) -> DataFrame:
    joined = _recent_attendance(daily, workforce, as_of, ["full_name", "department_name"], grain)
    person, department = ["employee_int_id", "full_name"], ["department_name"]
    totals = (joined.groupingSets([person, department], *person, *department)
              .agg(F.grouping("department_name").alias("by_person"),
                   *(weighted_sum(name).alias(name) for name in _SUMS)))
    by_person = F.col("by_person") == 1
    return _alerts(
        totals,
        F.when(by_person, _lateness_alert()), F.when(by_person, _overtime_alert()),
        F.when(~by_person & F.col("department_name").isNotNull(), _absence_alert()))


def executive_alerts(payroll: DataFrame, daily: DataFrame, workforce: DataFrame,
                     as_of: dt.date, *, detected_at: dt.datetime | None = None,
                     workforce_grain: Grain = "snapshot", ordered: bool = False) -> DataFrame:
    """All alerts, most urgent first when ``ordered``."""
    moment = F.current_timestamp() if detected_at is None else F.lit(detected_at)
    alerts = (high_arrears(payroll)
              .unionByName(_attendance_alerts(daily, workforce, as_of, workforce_grain))
              .unionByName(recent_terminations(workforce, as_of))
              .withColumn("detected_at", moment))
    if ordered:
        alerts = alerts.orderBy(*alert_order())
    return alerts


def priority_rank() -> Column:
    return F.array_position(F.array(*map(F.lit, PRIORITIES)), F.col("priority"))


def alert_order() -> list[Column]:
    return [priority_rank(), *ascending("alert_type", "employee_name", "employee_id", "detail")]
