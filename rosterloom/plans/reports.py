"""Reports over the views: the dashboard's queries and the documented examples.

Each takes the view frames it reads.  Top-k reports break ties by further
columns, so the cut is the same on every run.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from rosterloom.functions import (
    ascending,
    contains_pattern,
    descending,
    distinct_count,
    exact_mean,
    month_text,
    months_before,
    nullable_ratio,
    round_to,
    row_count,
)
from rosterloom.operators import (
    equals_where_given,
    keep,
    top_k,
    top_k_of_many,
    top_k_per_group,
    workforce_dimension,
)
from rosterloom.operators.workforce import KEY, Grain
from rosterloom.plans.alerts import priority_rank
from rosterloom.plans.bands import TENURE_BANDS, band_position

# Row caps of the reports.
DETAIL_ROWS = 500
SEARCH_ROWS = 100
ACTIVITY_ROWS = 100
ALERT_ROWS = 20
DEPARTMENT_ROWS = 15
PERIODS = 12
TAX_PERIODS = 6
TOP_ROWS = 10
ALERTS_SHOWN = 5


def _percent(part: str, whole: str) -> Column:
    return nullable_ratio(F.sum(part), F.sum(whole), 1, 100.0)


def _count_by(frame: DataFrame, column: str) -> DataFrame:
    return frame.groupBy(column).agg(row_count().alias("count"))


def _active(demographics: DataFrame) -> DataFrame:
    return demographics.where(F.col("employee_status") == "Active")


def period_window_start(as_of: dt.date, months: int = 6) -> dt.date:
    """First day of the month ``months`` before: where 'from period yyyy-MM' begins."""
    return months_before(as_of, months).replace(day=1)


# Executive page.

def kpi_row(kpis: DataFrame) -> DataFrame:
    return kpis.limit(1)


def attendance_trend(daily_metrics: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    since = F.lit(as_of - dt.timedelta(days=days))
    return (daily_metrics.where(F.col("attendance_date") >= since).groupBy("attendance_date")
            .agg(F.sum("present_count").alias("present"), F.sum("absent_count").alias("absent"),
                 _percent("present_count", "total_records").alias("rate"))
            .orderBy(*ascending("attendance_date")))


def payroll_by_period(period_metrics: DataFrame, as_of: dt.date) -> DataFrame:
    since = period_window_start(as_of).strftime("%Y-%m")
    return (period_metrics.where(F.col("pay_period") >= since).groupBy("pay_period")
            .agg(F.sum("total_gross_pay").alias("gross_pay"),
                 F.sum("total_employer_cost").alias("employer_cost"),
                 F.sum("employees_paid").alias("employees"))
            .orderBy(*ascending("pay_period")))


def top_alerts(alerts: DataFrame, k: int = ALERT_ROWS) -> DataFrame:
    order = [priority_rank(), *ascending("alert_type", "employee_name", "detail", "employee_id")]
    return (top_k(alerts, order, k)
            .select("alert_type", "priority", "employee_name", "description", "detail"))


def alerts_shown(alerts: DataFrame) -> DataFrame:
    """Of the top alerts: every high one, and the first five of each other priority."""
    top = top_alerts(alerts)
    order = ascending("alert_type", "employee_name", "detail")
    few = top_k_per_group(top.where(F.col("priority") != "High"), ["priority"], order,
                          ALERTS_SHOWN)
    return top.where(F.col("priority") == "High").unionByName(few)


def basic_counts(payroll: DataFrame, raw_payroll: DataFrame, attendance: DataFrame,
                 raw_activity: DataFrame) -> DataFrame:
    """The four overview counts shown when there are no KPIs, one row each."""
    def counted(name: str, frame: DataFrame, count: Column) -> DataFrame:
        return frame.agg(count.alias("cnt")).select(F.lit(name).alias("measure"), "cnt")

    parts = (counted("employees", payroll, distinct_count("employee_id")),
             counted("payroll_records", raw_payroll, row_count()),
             counted("attendance_records", attendance, row_count()),
             counted("activity_logs", raw_activity, row_count()))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# Workforce page.

def workforce_summary(demographics: DataFrame) -> DataFrame:
    return demographics.agg(
        distinct_count("employee_int_id").alias("total_employees"),
        distinct_count("employee_int_id", "employee_status = 'Active'").alias("active"),
        distinct_count("department_name").alias("departments"),
        round_to(exact_mean("tenure_years"), 1).alias("avg_tenure"))


def headcount_by_department(demographics: DataFrame, k: int = DEPARTMENT_ROWS) -> DataFrame:
    counts = _count_by(_active(demographics), "department_name")
    return top_k(counts, [*descending("count"), *ascending("department_name")], k)


def tenure_distribution(demographics: DataFrame) -> DataFrame:
    counts = _count_by(_active(demographics), "tenure_band")
    return counts.orderBy(band_position(F.col("tenure_band"), TENURE_BANDS))


def employee_types(demographics: DataFrame) -> DataFrame:
    counts = _count_by(_active(demographics), "employee_type")
    return counts.orderBy(*descending("count"), *ascending("employee_type"))


def manager_spans(demographics: DataFrame) -> DataFrame:
    counts = _count_by(_active(demographics), "manager_span")
    return counts.orderBy(*descending("count"), *ascending("manager_span"))


def department_choices(view: DataFrame) -> DataFrame:
    """Distinct department names of any view that has them."""
    return (view.where(F.col("department_name").isNotNull()).select("department_name")
            .distinct().orderBy("department_name"))


def departments_with_facts(facts: DataFrame, workforce: DataFrame,
                           workforce_grain: Grain = "snapshot") -> DataFrame:
    """Distinct department names a detail view over ``facts`` shows.

    The same names as :func:`department_choices` of that view, without building
    it: distinct employees on both sides, and a semi join.
    """
    homes = workforce_dimension(workforce.where(F.col(KEY).isNotNull()), ["department_name"],
                                workforce_grain)
    seen = facts.where(F.col(KEY).isNotNull()).select(KEY).distinct()
    return department_choices(homes.join(seen, KEY, "left_semi"))


def employee_details(demographics: DataFrame, *, department: str | None = None,
                     status: str | None = None, tenure_band: str | None = None) -> DataFrame:
    chosen = keep(demographics, equals_where_given(
        department_name=department, employee_status=status, tenure_band=tenure_band))
    columns = ["employee_id", "full_name", "department_name", "job_code_name", "employee_type",
               "employee_status", "tenure_band", "tenure_years", "direct_reports", "hourly_rate"]
    order = ascending("department_name", "full_name", "employee_id", "job_code_name",
                      "tenure_years", "hourly_rate")
    return top_k_of_many(chosen.select(*columns), order, DETAIL_ROWS)


# Attendance page.

def _between(frame: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return frame.where(F.col("attendance_date").between(F.lit(start), F.lit(end)))


def attendance_summary(daily_metrics: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return _between(daily_metrics, start, end).agg(
        F.sum("total_records").alias("total_records"), F.sum("present_count").alias("present"),
        F.sum("absent_count").alias("absent"), F.sum("late_count").alias("late"),
        # Through exact decimals: a sum of doubles depends on the order of addition.
        round_to(F.sum(F.col("ot_hours").cast("decimal(18,2)")), 1).alias("ot_hours"),
        _percent("present_count", "total_records").alias("attendance_rate"))


def daily_presence(daily_metrics: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return (_between(daily_metrics, start, end).groupBy("attendance_date")
            .agg(F.sum("present_count").alias("present"), F.sum("absent_count").alias("absent"))
            .orderBy(*ascending("attendance_date")))


def departments_by_attendance(daily_metrics: DataFrame, start: dt.date, end: dt.date,
                              k: int = TOP_ROWS) -> DataFrame:
    rates = (_between(daily_metrics, start, end).where(F.col("department_name").isNotNull())
             .groupBy("department_name")
             .agg(F.sum("present_count").alias("present"), F.sum("absent_count").alias("absent"),
                  _percent("present_count", "total_records").alias("rate")))
    return top_k(rates, [*descending("rate"), *ascending("department_name")], k)


def attendance_records(detail: DataFrame, start: dt.date, end: dt.date, *,
                       department: str | None = None, status: str | None = None,
                       late_only: bool = False) -> DataFrame:
    chosen = keep(_between(detail, start, end), equals_where_given(
        department_name=department, attendance_status=status, is_late=late_only or None))
    columns = ["attendance_date", "employee_name", "department_name", "attendance_status",
               "is_late", "late_by_mins", "total_hours", "ot_hours"]
    order = [*descending("attendance_date"), *ascending("employee_name", *columns[2:])]
    return top_k_of_many(chosen.select(*columns), order, DETAIL_ROWS)


# Payroll page.

def payroll_ytd_summary(period_metrics: DataFrame, as_of: dt.date) -> DataFrame:
    """Year totals; ``avg_pay`` is the plain mean of the departments' means."""
    return period_metrics.where(F.col("pay_year") == as_of.year).agg(
        distinct_count("pay_period").alias("periods"),
        F.sum("total_gross_pay").alias("total_gross"),
        F.sum("total_employer_cost").alias("total_cost"),
        round_to(exact_mean(F.col("avg_gross_pay").cast("decimal(18,2)")), 2).alias("avg_pay"),
        F.sum("employees_paid").alias("total_paid"))


def _last_periods(period_metrics: DataFrame, sums: dict[str, str], k: int) -> DataFrame:
    """The newest ``k`` periods, oldest first."""
    totals = period_metrics.groupBy("pay_period").agg(
        *(F.sum(column).alias(name) for name, column in sums.items()))
    return top_k(totals, descending("pay_period"), k).orderBy(*ascending("pay_period"))


def payroll_trend(period_metrics: DataFrame, k: int = PERIODS) -> DataFrame:
    return _last_periods(period_metrics, {"gross_pay": "total_gross_pay",
                                          "employer_cost": "total_employer_cost"}, k)


def deductions_and_taxes(period_metrics: DataFrame, k: int = TAX_PERIODS) -> DataFrame:
    return _last_periods(period_metrics, {"deductions": "total_deductions",
                                          "employee_taxes": "total_employee_taxes",
                                          "employer_taxes": "total_employer_taxes"}, k)


def latest_period_departments(latest_metrics: DataFrame, k: int = TOP_ROWS) -> DataFrame:
    """Departments by gross pay; ``latest_metrics`` holds the newest period only."""
    rows = latest_metrics.where(F.col("department_name").isNotNull()).select(
        "department_name", "total_gross_pay", "employees_paid")
    return top_k(rows, [*descending("total_gross_pay"),
                        *ascending("department_name", "employees_paid")], k)


def top_earners(latest_payroll: DataFrame, k: int = TOP_ROWS) -> DataFrame:
    """Pay rows by gross pay; ``latest_payroll`` holds the newest period only."""
    columns = ["employee_name", "department_name", "gross_pay", "total_hours",
               "effective_hourly_rate"]
    order = [*descending("gross_pay"), *ascending("employee_name", "department_name",
                                                  "total_hours", "effective_hourly_rate")]
    return top_k(latest_payroll.select(*columns), order, k)


def period_choices(pay: DataFrame, k: int = PERIODS) -> DataFrame:
    """The newest periods paid.  The master join adds none and drops none, so none is made."""
    months = (pay.where(F.col("pay_date").isNotNull())
              .select(F.trunc("pay_date", "MM").alias("month")).distinct())
    return top_k(months, descending("month"), k).select(month_text("month").alias("pay_period"))


def payroll_records(payroll_analytics: DataFrame, *, period: str | None = None,
                    department: str | None = None) -> DataFrame:
    chosen = keep(payroll_analytics, equals_where_given(
        pay_period=period, department_name=department))
    columns = ["employee_name", "department_name", "pay_period", "gross_pay", "net_pay",
               "deductions", "total_hours", "effective_hourly_rate"]
    order = [*descending("gross_pay"), *ascending(*(c for c in columns if c != "gross_pay"))]
    return top_k_of_many(chosen.select(*columns), order, DETAIL_ROWS)


def month_bounds(period: str) -> tuple[dt.date, dt.date]:
    """First and last day of a 'yyyy-MM' period, to filter pay dates with."""
    first = dt.datetime.strptime(period, "%Y-%m").date()
    return first, months_before(first, -1) - dt.timedelta(days=1)


# Directory, benefits and activity pages.

def employee_search(employees: DataFrame, text: str = "") -> DataFrame:
    """People whose name (any case) or id contains ``text``; everyone when empty."""
    if text:
        pattern = contains_pattern(text)
        employees = employees.where(F.lower("full_name").like(pattern.lower())
                                    | F.col("employee_id").like(pattern))
    columns = ["employee_id", "full_name", "num_benefit_plans", "benefit_plan_types",
               "total_current_arrears", "corp_id"]
    order = ascending("full_name", "employee_id", "total_current_arrears")
    return top_k(employees.select(*columns), order, SEARCH_ROWS)


def enrolment_by_plan_type(headcount: DataFrame) -> DataFrame:
    return headcount.select(
        "benefit_plan_type", "employee_count", "enrollment_records",
        F.round("avg_current_arrears", 2).alias("avg_arrears"),
    ).orderBy(*_enrolment_order())


def top_plan_types(headcount: DataFrame, k: int = TOP_ROWS) -> DataFrame:
    rows = headcount.select("benefit_plan_type", "employee_count", "enrollment_records",
                            F.round("avg_current_arrears", 2).alias("avg_arrears"))
    return top_k(rows, _enrolment_order(), k)


def _enrolment_order() -> list[Column]:
    return [*descending("employee_count"),
            *ascending("benefit_plan_type", "enrollment_records", "avg_arrears")]


def plan_type_choices(headcount: DataFrame) -> DataFrame:
    return headcount.select("benefit_plan_type").distinct()


def benefits_detail(payroll_detail: DataFrame, plan_type: str | None = None) -> DataFrame:
    chosen = keep(payroll_detail, equals_where_given(benefit_plan_type=plan_type))
    columns = ["employee_id", "full_name", "benefit_plan_type", "benefit_plan_name",
               "coverage_tier", "current_arrears", "total_arrears"]
    order = ascending("last_name", "first_name", "benefit_plan_type", "benefit_plan_name",
                      "coverage_tier", "employee_id", "current_arrears", "total_arrears")
    return top_k_of_many(chosen, order, DETAIL_ROWS).select(*columns)


def recent_activity(activity: DataFrame, k: int = ACTIVITY_ROWS) -> DataFrame:
    columns = ["activity_id", "activity_timestamp", "module", "activity_type", "entered_by",
               "system_ip"]
    order = [*descending("activity_timestamp"), *ascending("activity_id")]
    return top_k(activity.select(*columns), order, k)


def activity_by_module(activity: DataFrame, k: int = ACTIVITY_ROWS) -> DataFrame:
    """Module counts among the newest ``k`` activities; rows without a module are left out."""
    counts = _count_by(recent_activity(activity, k).where(F.col("module").isNotNull()), "module")
    return counts.orderBy(*descending("count"), *ascending("module"))


# Documented example queries, aimed at the views that hold their columns.

def longest_tenured(demographics: DataFrame, pay: DataFrame, k: int = TOP_ROWS) -> DataFrame:
    """With the gross pay to date of each one's newest cheque; only their cheques are looked at."""
    columns = ["full_name", "department_name", "job_code_name", "tenure_years",
               "estimated_annual_salary"]
    order = [*descending("tenure_years"), *ascending("full_name", *columns[1:3]),
             *ascending("estimated_annual_salary")]
    longest = top_k(_active(demographics).select(KEY, *columns), [*order, *ascending(KEY)], k)
    cheques = (pay.select(KEY, "pay_date", "payroll_work_id", "gross_pay_ytd")
               .join(longest.select(KEY).distinct(), KEY, "left_semi"))
    newest = cheques.groupBy(KEY).agg(
        F.max(F.struct("pay_date", "payroll_work_id", "gross_pay_ytd")).alias("_newest"))
    return (longest.join(newest, KEY, "left")
            .select(KEY, *columns, F.col("_newest.gross_pay_ytd").alias("ytd_gross_pay"))
            .orderBy(*order, *ascending(KEY)).drop(KEY))


def department_payroll(workforce_metrics: DataFrame) -> DataFrame:
    """Active headcount and yearly pay by department name, over its numbers."""
    salary = F.col("avg_hourly_rate").cast("decimal(18,6)") * F.lit(Decimal("2080"))
    return (workforce_metrics.groupBy("department_name")
            .agg(F.sum("active_employees").alias("active_employees"),
                 round_to(exact_mean(salary), 0).alias("avg_salary"),
                 F.sum("total_annual_payroll_estimate").alias("total_payroll"))
            .orderBy(*descending("active_employees"), *ascending("department_name")))


def monthly_payroll(period_metrics: DataFrame, overtime: DataFrame, k: int = PERIODS) -> DataFrame:
    """Pay sums of the newest months, with the overtime hours punched in them."""
    totals = period_metrics.groupBy("pay_period").agg(
        F.sum("employees_paid").alias("employees"), F.sum("total_gross_pay").alias("gross_pay"),
        F.sum("total_net_pay").alias("net_pay"), F.sum("total_hours").alias("hours"))
    return top_k(totals.join(overtime, "pay_period", "left"), descending("pay_period"), k)


def monthly_overtime(daily: DataFrame) -> DataFrame:
    return daily.groupBy(month_text("attendance_date").alias("pay_period")).agg(
        nullable_ratio(F.sum("ot_duration"), F.lit(60), 2).alias("overtime_hours"))


def monthly_attendance(daily_metrics: DataFrame, headcount: DataFrame, k: int = TOP_ROWS) -> DataFrame:
    """Attendance rates by month and department, newest month first.

    ``headcount`` (:func:`department_headcount`) counts a month's people: daily counts do not add up.
    """
    rates = (daily_metrics
             .groupBy(month_text("attendance_date").alias("year_month"), "department_name")
             .agg(F.sum("total_records").alias("total_records"),
                  _percent("present_count", "total_records").alias("attendance_rate_pct"),
                  _percent("absent_count", "total_records").alias("absence_rate_pct"),
                  _percent("late_count", "total_records").alias("late_rate_pct")))
    first = top_k(rates, [*descending("year_month"), *ascending("department_name")], k)
    joined = first.alias("r").join(headcount.alias("h"), (F.col("r.year_month") == F.col("h.year_month"))
                                   & F.col("r.department_name").eqNullSafe(F.col("h.department_name")), "left")
    return (joined.select("r.*", "h.employee_count")
            .orderBy(*descending("year_month"), *ascending("department_name")))


def department_headcount(daily: DataFrame, workforce: DataFrame,
                         workforce_grain: Grain = "snapshot") -> DataFrame:
    """Distinct employees with a punch, per month and department.

    Facts become distinct (month, employee) rows before they meet the master.
    """
    homes = workforce_dimension(workforce, ["department_name"], workforce_grain)
    seen = daily.where(F.col(KEY).isNotNull() & F.col("attendance_date").isNotNull()).select(
        month_text("attendance_date").alias("year_month"), KEY).distinct()
    people = seen.join(homes, KEY, "left").select("year_month", "department_name", KEY).distinct()
    return people.groupBy("year_month", "department_name").agg(row_count().alias("employee_count"))


def top_salaries(demographics: DataFrame, k: int = TOP_ROWS) -> DataFrame:
    columns = ["full_name", "department_name", "job_code_name", "estimated_annual_salary"]
    order = [*descending("estimated_annual_salary"), *ascending(*columns[:3])]
    return top_k(_active(demographics).select(*columns), order, k)


def salary_by_department(demographics: DataFrame) -> DataFrame:
    return demographics.groupBy("department_name").agg(
        row_count().alias("employees"),
        round_to(exact_mean("estimated_annual_salary"), 2).alias("avg_salary"))


def headcount_from_metrics(workforce_metrics: DataFrame) -> DataFrame:
    """The pre-aggregated twin of :func:`salary_by_department`."""
    return workforce_metrics.select(
        "department_name", "department_number", "active_employees",
        round_to(F.col("avg_hourly_rate"), 2).alias("avg_hourly_rate"))


def earnings_per_employee(workforce: DataFrame, pay: DataFrame) -> DataFrame:
    """Every master row with its employee's total gross pay.

    Pay is summed per employee before the join: one row per key on that side.
    """
    earned = (pay.groupBy("employee_int_id").agg(F.sum("gross_pay").alias("total_earnings")))
    return (workforce.select("employee_int_id", "full_name", "department_name")
            .join(earned, "employee_int_id", "left"))


def first_employees(employees: DataFrame, k: int = TOP_ROWS) -> DataFrame:
    order = ascending("employee_id", "employee_int_id", "first_name", "last_name")
    return top_k(employees, order, k)
