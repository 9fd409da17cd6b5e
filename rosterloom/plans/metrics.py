"""Metrics views: aggregates over staging and business views.

Distinct counts of whole-number ids come from bitmap words (:mod:`rosterloom.operators.bitmaps`): rows are grouped
by (keys, id div 64) first, pre-aggregated map-side, so a department or day holding a large share of all rows is spread
over its ids before it meets its key, and the groups' states can be stored and merged. Counts of text ids go through
``count(DISTINCT …) FILTER``, spread by the id in the same way.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from rosterloom.functions import (
    ascending,
    day_name,
    day_of_week,
    descending,
    distinct_count,
    exact_mean,
    guarded_ratio,
    iso_week,
    month_of,
    month_text,
    nullable_ratio,
    quarter_of,
    round_to,
    row_count,
    year_of,
)
from rosterloom.operators import join_workforce, workforce_dimension
from rosterloom.operators.bitmaps import SLOT, WORD, Measures, bits_of, counted, merged, states
from rosterloom.operators.workforce import COPIES, Grain
from rosterloom.plans.bands import AGE_BANDS, TENURE_BANDS
from rosterloom.plans.business import PAID_WEEKS_PER_YEAR, with_tenure_and_age

DEPARTMENT = ["department_name", "department_number"]


def calculated(frame: DataFrame, calculated_at: dt.datetime | None) -> DataFrame:
    """Appends ``calculated_at``: the query time unless given."""
    moment = F.current_timestamp() if calculated_at is None else F.lit(calculated_at)
    return frame.withColumn("calculated_at", moment)


DAY_GROUP = ["attendance_date", *DEPARTMENT]
# Attendance status ids by the count they go into.
STATUS_COUNTS = {"present_count": 1, "absent_count": 2, "leave_count": 3, "holiday_count": 4, "half_day_count": 5}


def attendance_measures() -> Measures:
    """What a day and department keeps: distinct punches by kind, people, and minutes."""
    minutes = {"total_late_minutes": "late_by_mins", "total_minutes": "total_duration",
               "pay_minutes": "pay_duration", "ot_minutes": "ot_duration",
               "break_minutes": "total_break_mins", "on_call_minutes": "on_call_duration"}
    return Measures(
        counts={"total_records": ("attendance_id", None),
                **{name: ("attendance_id", f"attendance_status_id = {status}") for name, status in STATUS_COUNTS.items()},
                "late_count": ("attendance_id", "is_late"), "early_leave_count": ("attendance_id", "is_early_leave"),
                "unique_employees": ("employee_int_id", None)},
        sums={name: F.col(column) * F.col(COPIES) for name, column in minutes.items()})


def attendance_states(daily: DataFrame, workforce: DataFrame, workforce_grain: Grain = "snapshot") -> DataFrame:
    """Mergeable states per day and department."""
    joined = join_workforce(daily.where(F.col("attendance_date").isNotNull()),
                            workforce_dimension(workforce, DEPARTMENT, workforce_grain),
                            ["attendance_date", "total_duration", "total_break_mins"])
    return states(joined, DAY_GROUP, attendance_measures())


def attendance_daily_metrics(daily: DataFrame, workforce: DataFrame, *,
                             workforce_grain: Grain = "snapshot",
                             calculated_at: dt.datetime | None = None,
                             ordered: bool = False) -> DataFrame:
    """Attendance counts, rates and hours per day and department."""
    return attendance_daily_from(attendance_states(daily, workforce, workforce_grain),
                                 calculated_at=calculated_at, ordered=ordered)


def attendance_daily_from(parts: DataFrame, *, calculated_at: dt.datetime | None = None,
                          ordered: bool = False) -> DataFrame:
    """:func:`attendance_daily_metrics` from states in which no slot of a day and department comes twice."""
    totals = counted(parts, DAY_GROUP, attendance_measures())
    day, records = F.col("attendance_date"), F.col("total_records")

    def in_hours(minutes: str):
        return F.col(minutes).cast("double") / F.lit(60.0)

    frame = totals.select(
        "attendance_date", year_of(day).alias("attendance_year"),
        month_of(day).alias("attendance_month"), iso_week(day).alias("attendance_week"),
        day_of_week(day).alias("day_of_week"), day_name(day).alias("day_name"), *DEPARTMENT,
        "total_records", "unique_employees", *STATUS_COUNTS, "late_count", "early_leave_count",
        guarded_ratio(F.col("present_count"), records, 1, 100.0).alias("presence_rate"),
        guarded_ratio(F.col("absent_count"), records, 1, 100.0).alias("absence_rate"),
        guarded_ratio(F.col("late_count"), records, 1, 100.0).alias("late_rate"),
        *(round_to(in_hours(f"{kind}_minutes"), 2).alias(f"{kind}_hours")
          for kind in ("total", "pay", "ot", "break", "on_call")),
        guarded_ratio(in_hours("total_minutes"), F.col("unique_employees"), 2)
        .alias("avg_hours_per_employee"),
        "total_late_minutes",
        guarded_ratio(F.col("total_late_minutes"), F.col("late_count"), 0)
        .alias("avg_late_minutes"))
    if ordered:
        frame = frame.orderBy(*descending("attendance_date"), *ascending(*DEPARTMENT))
    return calculated(frame, calculated_at)


def attendance_metrics(attendance: DataFrame, *, ordered: bool = False) -> DataFrame:
    """Weekly hours per week, shift and department."""
    keys = ["week_number", "shift", "dept_id"]
    flagged = F.col("shift_diff_flag")
    frame = attendance.where(F.col("employee_id").isNotNull()).groupBy(*keys).agg(
        distinct_count("employee_id").alias("employee_count"),
        row_count().alias("total_records"),
        F.sum("total_hours").alias("total_hours"), F.sum("hours").alias("hours_worked"),
        round_to(exact_mean("total_hours"), 2).alias("avg_hours"),
        round_to(exact_mean("rate"), 2).alias("avg_rate"),
        F.count_if(flagged).alias("shift_diff_count"),
        F.sum(F.when(flagged, F.col("hours")).otherwise(F.lit(0))).alias("shift_diff_hours"))
    return frame.orderBy(*ascending(*keys)) if ordered else frame


def clinical_workforce_metrics(employees: DataFrame, *, ordered: bool = False) -> DataFrame:
    """Benefit totals per company, over :func:`business.employee_summary`."""
    frame = employees.groupBy("corp_id").agg(
        distinct_count("employee_id").alias("employee_count"),
        F.sum("total_current_arrears").alias("total_current_arrears"),
        F.sum("total_arrears").alias("total_arrears"),
        round_to(exact_mean("num_benefit_plans"), 2).alias("avg_benefit_plans_per_employee"))
    return _by_headcount(frame, ordered, "corp_id")


def department_staffing_ratios(staffing: DataFrame, *, ordered: bool = False) -> DataFrame:
    """Staffing per department, shift and week, over :func:`business.staffing_by_shift`."""
    frame = staffing.groupBy("dept_id", "shift", "week_number").agg(
        F.sum("record_count").alias("total_records"),
        distinct_count("employee_id").alias("unique_employees"),
        F.sum("total_hours").alias("total_hours"), F.sum("hours").alias("hours_worked"),
        round_to(exact_mean("total_hours"), 2).alias("avg_hours"),
        F.sum("shift_diff_hours").alias("shift_diff_hours"))
    return frame.orderBy(*ascending("dept_id", "week_number", "shift")) if ordered else frame


def headcount_metrics(payroll: DataFrame, *, ordered: bool = False) -> DataFrame:
    """Enrolment per company and plan type."""
    keys = ["corp_id", "benefit_plan_type"]
    frame = payroll.where(F.col("employee_id").isNotNull()).groupBy(*keys).agg(
        distinct_count("employee_id").alias("employee_count"),
        row_count().alias("enrollment_records"),
        F.sum("current_arrears").alias("total_current_arrears"),
        F.sum("total_arrears").alias("total_arrears"),
        round_to(exact_mean("current_arrears"), 2).alias("avg_current_arrears"),
        round_to(exact_mean("age"), 1).alias("avg_age"))
    return _by_headcount(frame, ordered, *keys)


def monthly_payroll_metrics(payroll: DataFrame, *, ordered: bool = False) -> DataFrame:
    """Enrolment per company, plan type, plan and class."""
    keys = ["corp_id", "benefit_plan_type", "benefit_plan_name", "benefit_class_name"]
    frame = payroll.where(F.col("employee_id").isNotNull()).groupBy(*keys).agg(
        distinct_count("employee_id").alias("employee_count"),
        row_count().alias("enrollment_records"),
        F.sum("current_arrears").alias("total_current_arrears"),
        F.sum("total_arrears").alias("total_arrears"),
        F.count_if("arrears_assigned").alias("arrears_assigned_count"),
        F.sum("num_pay_periods").alias("total_pay_periods"))
    return _by_headcount(frame, ordered, *keys)


def _by_headcount(frame: DataFrame, ordered: bool, *keys: str) -> DataFrame:
    return frame.orderBy(*descending("employee_count"), *ascending(*keys)) if ordered else frame


PERIOD_GROUP = ["pay_month_start", *DEPARTMENT]


def payroll_measures() -> Measures:
    """What a period and department keeps: distinct cheques and people, extremes and sums of money."""
    sums = {"total_gross_pay": "gross_pay", "total_net_pay": "net_pay",
            "total_deductions": "deductions", "total_employee_taxes": "employee_taxes",
            "total_employer_taxes": "employer_taxes",
            "total_employer_contributions": "employer_amount",
            "total_employer_cost": "employer_cost", "total_hours": "total_hours",
            "total_401k_hours": "hours_401k", "total_check_amount": "check_amount",
            "total_dd_amount": "direct_deposit_amount"}
    return Measures(
        counts={"payroll_records": ("payroll_work_id", None), "employees_paid": ("employee_int_id", None),
                "check_payments": ("employee_int_id", "check_amount > 0"),
                "dd_payments": ("employee_int_id", "direct_deposit_amount > 0")},
        sums={"cheques": F.col(COPIES), **{name: F.col(column) * F.col(COPIES) for name, column in sums.items()}},
        least={"min_gross_pay": F.col("gross_pay")}, most={"max_gross_pay": F.col("gross_pay")},
        apart=True)


def payroll_states(pay: DataFrame, workforce: DataFrame, workforce_grain: Grain = "snapshot",
                   period: str = "pay_month_start") -> DataFrame:
    """Mergeable states per period (``pay_month_start``, or ``pay_date`` for single days) and department."""
    facts = (pay.where(F.col("pay_date").isNotNull())
             .withColumn("pay_month_start", F.trunc("pay_date", "MM"))
             .withColumn("employer_cost", F.col("gross_pay") + F.col("employer_taxes")
                         + F.col("employer_amount")))
    joined = join_workforce(facts, workforce_dimension(workforce, DEPARTMENT, workforce_grain),
                            ["pay_date", "gross_pay", "net_pay"])
    return states(joined, [period, *DEPARTMENT], payroll_measures())


def payroll_period_metrics(pay: DataFrame, workforce: DataFrame, *,
                           workforce_grain: Grain = "snapshot",
                           calculated_at: dt.datetime | None = None,
                           ordered: bool = False) -> DataFrame:
    """Pay totals per month and department."""
    return payroll_period_from(payroll_states(pay, workforce, workforce_grain),
                               calculated_at=calculated_at, ordered=ordered)


def payroll_period_from(parts: DataFrame, *, calculated_at: dt.datetime | None = None,
                        ordered: bool = False) -> DataFrame:
    """:func:`payroll_period_metrics` from states per month, or per day (``pay_date``), which are merged."""
    if "pay_month_start" not in parts.columns:
        parts = merged(parts.withColumn("pay_month_start", F.trunc("pay_date", "MM")), PERIOD_GROUP, payroll_measures())
    # One key for the month: year, month, quarter and text all follow from it.
    totals = counted(parts, PERIOD_GROUP, payroll_measures())
    month, paid, cheques = F.col("pay_month_start"), F.col("employees_paid"), F.col("cheques")

    def money(name: str):
        return F.round(name, 2).alias(name)

    frame = totals.select(
        month_text(month).alias("pay_period"), year_of(month).alias("pay_year"),
        month_of(month).alias("pay_month"), quarter_of(month).alias("pay_quarter"), *DEPARTMENT,
        "payroll_records", "employees_paid", money("total_gross_pay"), money("total_net_pay"),
        nullable_ratio(F.col("total_gross_pay"), cheques, 2).alias("avg_gross_pay"),
        nullable_ratio(F.col("total_net_pay"), cheques, 2).alias("avg_net_pay"),
        money("min_gross_pay"), money("max_gross_pay"), money("total_deductions"),
        money("total_employee_taxes"), money("total_employer_taxes"),
        money("total_employer_contributions"), money("total_employer_cost"),
        guarded_ratio(F.col("total_employer_cost"), paid, 2)
        .alias("avg_employer_cost_per_employee"),
        F.round("total_hours", 1).alias("total_hours"),
        nullable_ratio(F.col("total_hours"), cheques, 1).alias("avg_hours_per_employee"),
        guarded_ratio(F.col("total_gross_pay"), F.col("total_hours"), 2)
        .alias("effective_hourly_rate"),
        F.round("total_401k_hours", 1).alias("total_401k_hours"), money("total_check_amount"),
        money("total_dd_amount"), "check_payments", "dd_payments",
        guarded_ratio(F.col("dd_payments"), paid, 1, 100.0).alias("dd_adoption_rate"))
    if ordered:
        frame = frame.orderBy(*descending("pay_period"), *ascending(*DEPARTMENT))
    return calculated(frame, calculated_at)


def shift_coverage_metrics(staffing: DataFrame, *, ordered: bool = False) -> DataFrame:
    """Staffing per shift and week, over :func:`business.staffing_by_shift`."""
    frame = staffing.groupBy("shift", "week_number").agg(
        distinct_count("employee_id").alias("staff_count"),
        F.sum("record_count").alias("total_records"),
        F.sum("total_hours").alias("total_hours"), F.sum("hours").alias("hours_worked"),
        # A mean of means: from six exact decimals, so any order of addition agrees.
        round_to(exact_mean(F.col("avg_rate").cast("decimal(18,6)")), 2).alias("avg_rate"),
        F.sum("shift_diff_hours").alias("shift_diff_hours"),
        nullable_ratio(F.sum("shift_diff_hours"), F.sum("hours"), 2, 100.0)
        .alias("shift_diff_pct"))
    return frame.orderBy(*ascending("week_number", "shift")) if ordered else frame


def workforce_metrics(workforce: DataFrame, as_of: dt.date, *,
                      calculated_at: dt.datetime | None = None,
                      ordered: bool = False) -> DataFrame:
    """Headcount, tenure, pay and leave per department and number, with band counts.

    The band counts are per department *name*, and repeat for each number of it: both grains come from the same
    states, so the employees are read once and nothing is joined.
    """
    staff = with_tenure_and_age(workforce.where(F.col("department_name").isNotNull()), as_of)
    hired_within = {days: f"hire_date >= DATE'{as_of - dt.timedelta(days=days)}'"
                    for days in (30, 90)}
    conditions = {
        "total_employees": None,
        "active_employees": "employee_status = 'Active'",
        "terminated_employees": "employee_status = 'Terminated'",
        "full_time_count": "employee_type = 'Full Time'",
        "part_time_count": "employee_type = 'Part Time'",
        "prn_count": "employee_type = 'PRN'",
        "male_count": "gender = 'M'",
        "female_count": "gender = 'F'",
        "new_hires_30d": hired_within[30],
        "new_hires_90d": hired_within[90],
    }
    tenure_columns = ("tenure_under_1yr", "tenure_1_2yr", "tenure_3_4yr", "tenure_5_9yr",
                      "tenure_10_19yr", "tenure_20plus")
    age_columns = ("age_under_25", "age_25_34", "age_35_44", "age_45_54", "age_55_64",
                   "age_65plus")
    bands = {**{name: f"tenure_band = '{label}'" for name, (label, _) in zip(tenure_columns, TENURE_BANDS)},
             **{name: f"age_band = '{label}'" for name, (label, _) in zip(age_columns, AGE_BANDS)}}
    averaged = {"avg_tenure_years": "tenure_years", "avg_hourly_rate": "hourly_rate",
                "avg_pto_balance": "pto_balance", "avg_sick_balance": "sick_balance"}
    yearly_pay = F.col("hourly_rate") * F.col("standard_weekly_hours") * PAID_WEEKS_PER_YEAR
    measures = Measures(
        counts={name: ("employee_int_id", where) for name, where in {**conditions, **bands}.items()},
        sums={"total_annual_payroll_estimate": yearly_pay,
              **{f"_sum_{name}": F.col(column) for name, column in averaged.items()},
              **{f"_n_{name}": F.when(F.col(column).isNotNull(), F.lit(1)) for name, column in averaged.items()}},
        least={"min_tenure_years": F.col("tenure_years"), "min_hourly_rate": F.col("hourly_rate")},
        most={"max_tenure_years": F.col("tenure_years"), "max_hourly_rate": F.col("hourly_rate")})
    parts = states(staff, DEPARTMENT, measures)
    # A name's bits of a slot are those of all its numbers; the first number's row counts them.
    same = Window.partitionBy("department_name", SLOT)
    first = F.row_number().over(same.orderBy(*ascending("department_number"))) == 1
    parts = parts.withColumn("_named", F.when(first, F.bit_or(WORD).over(same)))
    of_name = dict(zip(bands, bits_of(bands, measures, F.col("_named"))))
    totals = counted(parts, DEPARTMENT, measures, names=conditions, further={f"_{n}": c for n, c in of_name.items()})
    whole = Window.partitionBy("department_name")
    frame = totals.select(
        *DEPARTMENT, *conditions,
        *(F.try_divide(F.col(f"_sum_{name}").cast("double"), F.col(f"_n_{name}")).alias(name) if name in averaged
          else F.col(f"_sum_avg_{name[6:]}").alias(name) if name in ("total_pto_balance", "total_sick_balance")
          else F.col(name) for name in (
              "avg_tenure_years", "min_tenure_years", "max_tenure_years", "avg_hourly_rate", "min_hourly_rate",
              "max_hourly_rate", "total_annual_payroll_estimate", "total_pto_balance", "total_sick_balance",
              "avg_pto_balance", "avg_sick_balance")),
        *(F.sum(f"_{name}").over(whole).alias(name) for name in bands))
    if ordered:
        frame = frame.orderBy(*descending("active_employees"), *ascending(*DEPARTMENT))
    return calculated(frame, calculated_at)
