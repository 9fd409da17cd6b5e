"""Business views: staging rows joined, labelled and summarised for readers.

Views the source sorts take ``ordered``; it is off by default, because a global
sort inside a composed query is thrown away by the next shuffle.  The sort keys
end in further columns so that a large group of equal leading keys can still be
split over range partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from rosterloom.functions import (
    ascending,
    day_name,
    day_of_week,
    distinct_count,
    exact_mean,
    full_name,
    hours,
    month_of,
    month_text,
    quarter_of,
    round_to,
    row_count,
    year_of,
    years_between,
)
from rosterloom.operators import expand_copies, join_workforce, workforce_dimension
from rosterloom.operators.workforce import Grain
from rosterloom.plans.bands import AGE_BANDS, SPAN_BANDS, TENURE_BANDS, UNKNOWN, band

# Attendance status texts by status id.
STATUS_TEXTS = {1: "Present", 2: "Absent", 3: "Leave", 4: "Holiday", 5: "Half Day",
                6: "Weekend", 7: "Work From Home"}
PAID_WEEKS_PER_YEAR = 52


def status_text(status: Column) -> Column:
    texts = F.create_map(*(F.lit(part) for pair in STATUS_TEXTS.items() for part in pair))
    return F.coalesce(F.try_element_at(texts, status.cast("int")), F.lit(UNKNOWN))


def _sorted(frame: DataFrame, ordered: bool, *keys: str) -> DataFrame:
    return frame.orderBy(*ascending(*keys)) if ordered else frame


def attendance_detail(attendance: DataFrame, *, ordered: bool = False) -> DataFrame:
    frame = attendance.where(F.col("employee_id").isNotNull()).select(
        "employee_id", "employee_int_id", "first_name", "last_name",
        full_name().alias("full_name"), "week_number", "shift", "total_hours", "hours", "rate",
        "earning_code", "earning_number", "job_code", "dept_id", "shift_diff_flag",
        "source_table", F.col("_loaded_at").alias("last_updated"))
    return _sorted(frame, ordered, "employee_id", "week_number", "shift", "earning_code",
                   "job_code", "dept_id", "hours", "rate")


DETAIL_ATTRIBUTES = ["employee_id", "full_name", "department_name", "department_number", "job_code_name"]


# The columns of a punch that the view shows.
DETAIL_PUNCHES = [
    "attendance_id", "employee_int_id", "attendance_date", "scheduled_in_time", "actual_in_time", "out_time", "planned_end_time",
    "attendance_status_id", "first_half_status", "second_half_status", "is_late", "late_by_mins", "is_early_leave",
    "early_left_by_mins", "is_absent", "absent_minutes", "total_duration", "total_net_duration", "pay_duration",
    "shift_work_duration", "has_overtime", "ot_start_time", "ot_end_time", "ot_duration", "ot_net_duration", "total_break_mins",
    "on_call_duration", "call_back_duration", "time_mgt_code", "hr_flag", "entered_date"]


def daily_attendance_detail(daily: DataFrame, workforce: DataFrame, *,
                            workforce_grain: Grain = "snapshot") -> DataFrame:
    people = workforce_dimension(workforce, DETAIL_ATTRIBUTES, workforce_grain)
    return daily_attendance_detail_of(join_workforce(
        daily.where(F.col("attendance_date").isNotNull()), people, ["attendance_id", "attendance_date"]))


def daily_attendance_detail_of(joined: DataFrame) -> DataFrame:
    """The view from dated punches that are joined to their people already."""
    day = F.col("attendance_date")
    in_hours = {"total_hours": "total_duration", "net_hours": "total_net_duration",
                "pay_hours": "pay_duration", "shift_hours": "shift_work_duration",
                "ot_hours": "ot_duration", "ot_net_hours": "ot_net_duration",
                "total_break_hours": "total_break_mins", "on_call_hours": "on_call_duration",
                "call_back_hours": "call_back_duration"}
    converted = {name: hours(F.col(source)).alias(name) for name, source in in_hours.items()}
    joined = joined.select(
        "attendance_id", "employee_int_id", "employee_id",
        F.col("full_name").alias("employee_name"), "department_name", "department_number",
        "job_code_name", "attendance_date", year_of(day).alias("attendance_year"),
        month_of(day).alias("attendance_month"), day_of_week(day).alias("day_of_week"),
        day_name(day).alias("day_name"), "scheduled_in_time", "actual_in_time", "out_time",
        "planned_end_time", status_text(F.col("attendance_status_id")).alias("attendance_status"),
        "first_half_status", "second_half_status", "is_late", "late_by_mins", "is_early_leave",
        "early_left_by_mins", "is_absent", "absent_minutes", converted["total_hours"],
        converted["net_hours"], converted["pay_hours"], converted["shift_hours"], "has_overtime",
        "ot_start_time", "ot_end_time", converted["ot_hours"], converted["ot_net_hours"],
        converted["total_break_hours"], converted["on_call_hours"],
        converted["call_back_hours"], "time_mgt_code", "hr_flag", "entered_date", "copies")
    return expand_copies(joined)


def employee_summary(payroll: DataFrame) -> DataFrame:
    """One row per benefits person.

    Lines are first summed per plan, which leaves at most one row per person and
    plan; the list of plan types is then built from those few rows, so a person
    holding a large share of all lines costs no more than any other. Lines are
    dealt by person and plan before the sums: few share both, so sums per split
    of a file would hold nearly all of its lines at once and save no shuffle.
    """
    person = ["employee_id", "employee_int_id", "first_name", "last_name"]
    plan = [*person, "benefit_plan_name", "benefit_plan_type"]
    per_plan = (payroll.where(F.col("employee_id").isNotNull())
                .repartition(*plan).groupBy(*plan)
                .agg(F.sum("current_arrears").alias("current_arrears"),
                     F.sum("total_arrears").alias("total_arrears"),
                     F.max("corp_id").alias("corp_id"),
                     F.max("_loaded_at").alias("last_updated")))
    plan_types = F.array_join(F.array_sort(F.collect_set("benefit_plan_type")), ", ")
    return (per_plan.groupBy(*person)
            .agg(distinct_count("benefit_plan_name").alias("num_benefit_plans"),
                 # No plan type at all is null, not an empty text.
                 F.when(F.count("benefit_plan_type") > 0, plan_types).alias("benefit_plan_types"),
                 F.sum("current_arrears").alias("total_current_arrears"),
                 F.sum("total_arrears").alias("total_arrears"),
                 F.max("corp_id").alias("corp_id"),
                 F.max("last_updated").alias("last_updated"))
            .select(*person, full_name().alias("full_name"), "num_benefit_plans",
                    "benefit_plan_types", "total_current_arrears", "total_arrears", "corp_id",
                    "last_updated"))


def payroll_analytics(pay: DataFrame, workforce: DataFrame, *,
                      workforce_grain: Grain = "snapshot") -> DataFrame:
    people = workforce_dimension(
        workforce, ["employee_id", "full_name", "department_name", "department_number",
                    "job_code_name", "employee_type", "employee_status", "hourly_rate"],
        workforce_grain)
    day, base_rate = F.col("pay_date"), F.col("hourly_rate")
    per_hour = F.try_divide(F.col("gross_pay").cast("double"), F.col("total_hours").cast("double"))
    worked = F.col("total_hours") > 0
    joined = join_workforce(pay.where(day.isNotNull()), people,
                            ["payroll_work_id", "pay_date"]).select(
        "payroll_work_id", "employee_int_id", "employee_id",
        F.col("full_name").alias("employee_name"), "department_name", "department_number",
        "job_code_name", "employee_type", "employee_status", "timecard_date", "pay_date",
        "check_date", year_of(day).alias("pay_year"), month_of(day).alias("pay_month"),
        quarter_of(day).alias("pay_quarter"), month_text(day).alias("pay_period"), "gross_pay",
        "net_pay", "gross_pay_ytd", "deductions", "deductions_ytd", "employee_taxes",
        "employee_taxes_ytd", "employer_taxes", "employer_taxes_ytd", "employer_amount",
        "employer_amount_ytd",
        (F.col("gross_pay") + F.col("employer_taxes") + F.col("employer_amount"))
        .alias("total_employer_cost"),
        "total_hours", "total_hours_ytd",
        F.when(worked, round_to(per_hour, 2)).otherwise(base_rate.cast("double"))
        .alias("effective_hourly_rate"),
        base_rate.alias("base_hourly_rate"),
        F.when(worked & (base_rate > 0), round_to(per_hour - base_rate.cast("double"), 2))
        .otherwise(F.lit(0.0)).alias("rate_premium"),
        "check_number", "check_amount", "direct_deposit_amount", "deposit_type",
        "payroll_status", "payment_status", "timecard_status", "payroll_type",
        "payslip_released", "hours_401k", "hours_401k_ytd", "created_date",
        "last_modified_date", "copies")
    return expand_copies(joined)


def payroll_detail(payroll: DataFrame, *, ordered: bool = False) -> DataFrame:
    frame = payroll.where(F.col("employee_id").isNotNull()).select(
        "employee_id", "employee_int_id", "first_name", "last_name",
        full_name().alias("full_name"), "benefit_plan_type", "benefit_plan_name",
        "benefit_class_name", "coverage_tier", "relationship", "cost_tier_effective_date",
        "coverage_amount_1", "coverage_amount_2", "per_pay_period_amount_1",
        "per_pay_period_amount_2", "employer_cost", "employer_cost_per_pay_period",
        "current_arrears", "total_arrears", "num_pay_periods", "arrears_assigned",
        "record_type", "reason", "age", "corp_id", "source_table",
        F.col("_loaded_at").alias("last_updated"))
    return _sorted(frame, ordered, "last_name", "first_name", "benefit_plan_type",
                   "benefit_plan_name", "coverage_tier", "employee_id", "current_arrears")


def clinical_staff_summary(employees: DataFrame, *, ordered: bool = False) -> DataFrame:
    """The columns of :func:`employee_summary`, by name."""
    frame = employees.select(
        "employee_id", "employee_int_id", "full_name", "first_name", "last_name",
        "num_benefit_plans", "benefit_plan_types", "total_current_arrears", "total_arrears",
        "corp_id", "last_updated")
    return _sorted(frame, ordered, "full_name", "employee_id", "employee_int_id")


def staffing_by_shift(attendance: DataFrame, *, ordered: bool = False) -> DataFrame:
    keys = ["employee_id", "first_name", "last_name", "shift", "week_number", "dept_id",
            "job_code"]
    frame = (attendance.where(F.col("employee_id").isNotNull()).groupBy(*keys)
             .agg(F.sum("total_hours").alias("total_hours"), F.sum("hours").alias("hours"),
                  exact_mean("rate").alias("avg_rate"),
                  F.sum(F.when(F.col("shift_diff_flag"), F.col("hours")).otherwise(F.lit(0)))
                  .alias("shift_diff_hours"),
                  row_count().alias("record_count"))
             .select("employee_id", "first_name", "last_name", full_name().alias("full_name"),
                     *keys[3:], "total_hours", "hours", "avg_rate", "shift_diff_hours",
                     "record_count"))
    return _sorted(frame, ordered, "employee_id", "week_number", "shift", "dept_id", "job_code")


def with_tenure_and_age(workforce: DataFrame, as_of: dt.date) -> DataFrame:
    """Adds tenure and age in calendar years, and their bands."""
    tenure, age = years_between("hire_date", as_of), years_between("date_of_birth", as_of)
    return workforce.select("*", tenure.alias("tenure_years"), age.alias("age"),
                            band(tenure, TENURE_BANDS).alias("tenure_band"),
                            band(age, AGE_BANDS).alias("age_band"))


def workforce_demographics(workforce: DataFrame, as_of: dt.date) -> DataFrame:
    """Employee rows with bands, the number of active reports and a salary estimate.

    Managers are matched by full name, so people sharing a name share the count.
    """
    reports = (workforce.where(F.col("employee_status") == "Active")
               .where(F.col("reporting_manager").isNotNull())
               .groupBy(F.col("reporting_manager").alias("full_name"))
               .agg(distinct_count("employee_int_id").alias("direct_report_count")))
    count = F.coalesce("direct_report_count", F.lit(0).cast("long"))
    salary = F.col("hourly_rate") * F.col("standard_weekly_hours") * PAID_WEEKS_PER_YEAR
    return (with_tenure_and_age(workforce, as_of)
            .join(reports, "full_name", "left")
            .select("employee_int_id", "employee_id", "first_name", "last_name", "full_name",
                    "employee_type", "employee_status", "gender", "hire_date", "date_of_birth",
                    "department_number", "department_name", "dept_manager", "reporting_manager",
                    "job_code", "job_code_name", "standard_weekly_hours", "hourly_rate",
                    "flsa_exempt", "nurse_type", "payroll_type", "tenure_years", "age",
                    "pto_balance", "sick_balance", "tenure_band", "age_band",
                    count.alias("direct_reports"), band(count, SPAN_BANDS).alias("manager_span"),
                    F.when(F.col("hourly_rate") > 0, salary).otherwise(F.lit(0))
                    .alias("estimated_annual_salary")))
