"""The one-row executive KPI view and the aggregates it is made of."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from rosterloom.functions import (
    distinct_count,
    guarded_ratio,
    month_text,
    months_before,
    round_to,
)
from rosterloom.plans.metrics import calculated

WINDOW_DAYS = 30
TREND_MONTHS = 6


def headcount(workforce: DataFrame, as_of: dt.date) -> DataFrame:
    since = as_of - dt.timedelta(days=WINDOW_DAYS)
    person = "employee_int_id"
    return workforce.agg(
        distinct_count(person).alias("total_employees"),
        distinct_count(person, "employee_status = 'Active'").alias("active_employees"),
        distinct_count(person, "employee_status = 'Terminated'").alias("terminated_employees"),
        distinct_count(person, f"hire_date >= DATE'{since}'").alias("new_hires_30d"),
        distinct_count("department_name").alias("total_departments"))


def attendance_window(daily: DataFrame, as_of: dt.date) -> DataFrame:
    since = F.lit(as_of - dt.timedelta(days=WINDOW_DAYS))
    record = "attendance_id"
    return daily.where(F.col("attendance_date") >= since).agg(
        distinct_count(record).alias("total_attendance_records"),
        distinct_count("employee_int_id").alias("employees_with_attendance"),
        distinct_count(record, "attendance_status_id = 1").alias("present_days"),
        distinct_count(record, "attendance_status_id IN (2, 3, 5)").alias("absent_days"),
        distinct_count(record, "is_late").alias("late_arrivals"),
        (F.sum("ot_duration").cast("double") / F.lit(60.0)).alias("total_ot_hours"))


def latest_payroll(pay: DataFrame) -> DataFrame:
    """Totals of the newest pay date: no row when nothing was ever paid.

    The date is a scalar subquery, which Spark also hands to the Parquet scan.
    """
    newest = pay.agg(F.max("pay_date")).scalar()
    cost = F.col("employer_taxes") + F.col("employer_amount")
    return pay.where(F.col("pay_date") == newest).groupBy("pay_date").agg(
        F.sum("gross_pay").alias("total_gross_pay"), F.sum("net_pay").alias("total_net_pay"),
        F.sum("total_hours").alias("total_hours"), F.sum(cost).alias("total_employer_cost"),
        distinct_count("employee_int_id").alias("employees_paid"))


def payroll_ytd(pay: DataFrame, as_of: dt.date) -> DataFrame:
    """Totals of the calendar year, chosen by a date range so partitions prune."""
    cost = F.col("employer_taxes") + F.col("employer_amount")
    return pay.where(in_year("pay_date", as_of.year)).agg(
        F.sum("gross_pay").alias("gross_pay_ytd"), F.sum("net_pay").alias("net_pay_ytd"),
        F.sum(cost).alias("employer_cost_ytd"))


def in_year(column: str, year: int):
    return ((F.col(column) >= F.lit(dt.date(year, 1, 1)))
            & (F.col(column) < F.lit(dt.date(year + 1, 1, 1))))


def payroll_trend(pay: DataFrame, as_of: dt.date) -> DataFrame:
    """Gross pay of the newest month among the last six months."""
    since = F.lit(months_before(as_of, TREND_MONTHS))
    return (pay.where(F.col("pay_date") >= since)
            .groupBy(F.trunc("pay_date", "MM").alias("month"))
            .agg(F.sum("gross_pay").alias("period_gross_pay"))
            .orderBy(F.col("month").desc()).limit(1)
            .select(month_text("month").alias("pay_period"), "period_gross_pay"))


def executive_kpis(workforce: DataFrame, daily: DataFrame, pay: DataFrame,
                   as_of: dt.date, *,
                   calculated_at: dt.datetime | None = None) -> DataFrame:
    """One row, or none when there is no pay row.

    The latest payroll is the driving row; the other aggregates join it as
    one-row scalar subqueries instead of through cross joins.
    """
    def as_struct(frame: DataFrame):
        return frame.select(F.struct("*")).scalar()

    rows = latest_payroll(pay).select(
        "*", as_struct(headcount(workforce, as_of)).alias("h"),
        as_struct(attendance_window(daily, as_of)).alias("a"),
        as_struct(payroll_ytd(pay, as_of)).alias("y"))
    present, absent = F.col("a.present_days"), F.col("a.absent_days")
    active = F.col("h.active_employees")
    frame = rows.select(
        "h.active_employees", "h.total_employees", "h.terminated_employees", "h.new_hires_30d",
        "h.total_departments",
        F.col("a.total_attendance_records").alias("attendance_records_30d"),
        "a.present_days", "a.absent_days", F.col("a.late_arrivals").alias("late_arrivals_30d"),
        guarded_ratio(present, present + absent, 1, 100.0).alias("attendance_rate_30d"),
        round_to(F.col("a.total_ot_hours"), 1).alias("total_ot_hours_30d"),
        F.col("pay_date").alias("latest_pay_date"),
        F.round("total_gross_pay", 2).alias("latest_gross_payroll"),
        F.round("total_net_pay", 2).alias("latest_net_payroll"),
        F.round("total_employer_cost", 2).alias("latest_employer_cost"),
        F.col("employees_paid").alias("latest_employees_paid"),
        F.round("total_hours", 1).alias("latest_total_hours"),
        F.round("y.gross_pay_ytd", 2).alias("ytd_gross_payroll"),
        F.round("y.net_pay_ytd", 2).alias("ytd_net_payroll"),
        F.round("y.employer_cost_ytd", 2).alias("ytd_employer_cost"),
        guarded_ratio(F.col("total_gross_pay"), active, 2).alias("avg_gross_pay_per_employee"),
        guarded_ratio(F.col("total_hours"), F.col("employees_paid"), 1)
        .alias("avg_hours_per_employee"))
    return calculated(frame, calculated_at)
