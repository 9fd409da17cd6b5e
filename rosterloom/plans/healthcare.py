"""Hospital staffing: roles, care units, shifts, burnout risk and their reports.

The documentation names the categories and columns but states no rules for
most of them.  Where it is silent the rule here is ours, and a parameter:
role and unit patterns, burnout hours, the staffing minimums.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rosterloom.functions import (
    ascending,
    descending,
    distinct_count,
    exact_mean,
    month_text,
    nullable_ratio,
    round_to,
    row_count,
    years_between,
)
from rosterloom.operators import latest_workforce, top_k

Rules = Sequence[tuple[str, str]]

# The documented category names.
RN, LPN, CNA = "Registered Nurse", "Licensed Practical Nurse", "Certified Nursing Assistant"
ICU, ER, SURGERY = "ICU/Critical Care", "Emergency Department", "Surgical Services"
DAY, EVENING, NIGHT = "Day Shift", "Evening Shift", "Night Shift"
HIGH, MODERATE, LOW = "High Risk", "Moderate Risk", "Low Risk"
UNKNOWN = "Unknown"
CRITICAL_UNITS = (ICU, ER, SURGERY)

# Our rules: label and pattern over the lower-case text, first match wins.
ROLE_RULES: Rules = (
    (LPN, r"\blpn\b|licensed practical"),
    (CNA, r"\bcna\b|nursing assistant"),
    ("Advanced Practice Provider", r"nurse practitioner|physician assistant|\bcrna\b"),
    (RN, r"\brn\b|registered nurse"),
    ("Physician", r"physician|surgeon"),
    ("Technician", r"technician|technologist"),
)
UNIT_RULES: Rules = (
    (ICU, r"\bicu\b|critical care|intensive"),
    (ER, r"\ber\b|emergency"),
    (SURGERY, r"surg|operating room"),
    ("Labor & Delivery", r"labor|delivery|obstetric"),
    ("Pediatrics", r"pediatric"),
)
OTHER_ROLE, OTHER_UNIT = "Other", "General Care"
HIGH_OVERTIME_HOURS, MODERATE_OVERTIME_HOURS = 40.0, 20.0
EXTENDED_SHIFT_MINUTES = 12 * 60
MINIMUM_STAFF, MINIMUM_RNS = 2, 2


def classify(text: Column, rules: Rules, otherwise: str) -> Column:
    chosen = F.when(F.lit(False), F.lit(None).cast("string"))
    for label, pattern in rules:
        chosen = chosen.when(F.lower(text).rlike(pattern), label)
    return chosen.otherwise(otherwise)


def shift_type(moment: Column) -> Column:
    """Day 06–14, evening 14–22, night 22–06 by the hour of clocking in."""
    hour = F.hour(moment)
    return (F.when(moment.isNull(), UNKNOWN).when((hour >= 6) & (hour < 14), DAY)
            .when((hour >= 14) & (hour < 22), EVENING).otherwise(NIGHT))


def day_type(day: Column) -> Column:
    return F.when(F.dayofweek(day).isin(1, 7), "Weekend").otherwise("Weekday")


def _classified_staff(workforce: DataFrame, roles: Rules, units: Rules) -> DataFrame:
    """One row per employee (newest snapshot) with role and unit."""
    newest = latest_workforce(workforce, ["employee_id", "full_name", "department_name",
                                          "job_code_name", "employee_status", "hire_date"])
    return newest.select(
        "employee_int_id", "employee_id", "full_name",
        F.col("department_name").alias("department"),
        classify(F.col("job_code_name"), roles, OTHER_ROLE).alias("clinical_role"),
        classify(F.col("department_name"), units, OTHER_UNIT).alias("care_unit_type"),
        F.col("employee_status").alias("employment_status"), "hire_date")


def clinical_staff(workforce: DataFrame, daily: DataFrame, as_of: dt.date, *,
                   roles: Rules = ROLE_RULES, units: Rules = UNIT_RULES,
                   high_hours: float = HIGH_OVERTIME_HOURS,
                   moderate_hours: float = MODERATE_OVERTIME_HOURS) -> DataFrame:
    """Employees with role, unit, year-to-date overtime, attendance and burnout risk.

    Attendance is reduced to one row per employee first, so the join is one to
    one whatever the number of punches.
    """
    punches = (daily.where(F.col("attendance_date").between(
                   F.lit(dt.date(as_of.year, 1, 1)), F.lit(as_of)))
               .groupBy("employee_int_id")
               .agg(F.sum("ot_duration").alias("ot_minutes"),
                    F.sum("total_duration").alias("worked_minutes"),
                    F.count_if(F.col("attendance_status_id") == 1).alias("present_rows"),
                    row_count().alias("day_rows")))
    overtime = F.coalesce("ot_minutes", F.lit(0).cast("long"))
    overtime_hours = overtime.cast("double") / F.lit(60.0)
    risk = (F.when(overtime_hours >= high_hours, HIGH)
            .when(overtime_hours >= moderate_hours, MODERATE).otherwise(LOW))
    return (_classified_staff(workforce, roles, units).join(punches, "employee_int_id", "left")
            .select("employee_int_id", "employee_id", "full_name", "department",
                    "clinical_role", "care_unit_type", "employment_status",
                    years_between("hire_date", as_of).alias("tenure_years"),
                    round_to(overtime_hours, 2).alias("ytd_overtime_hours"),
                    nullable_ratio(overtime, F.col("worked_minutes"), 2, 100.0)
                    .alias("overtime_percentage"),
                    nullable_ratio(F.col("present_rows"), F.col("day_rows"), 1, 100.0)
                    .alias("attendance_rate_pct"),
                    risk.alias("burnout_risk_level")))


def shift_punches(daily: DataFrame) -> DataFrame:
    """Punches with shift type, day type, extended and differential flags."""
    start = F.coalesce("actual_in_time", "scheduled_in_time")
    shift, kind = shift_type(start), day_type(F.col("attendance_date"))
    return daily.select(
        "attendance_date", "employee_int_id", shift.alias("shift_type"), kind.alias("day_type"),
        F.col("total_duration").cast("long").alias("worked_minutes"),
        F.col("ot_duration").cast("long").alias("overtime_minutes"),
        (F.col("total_duration") > EXTENDED_SHIFT_MINUTES).alias("is_extended_shift"),
        (shift.isin(EVENING, NIGHT) | (kind == "Weekend")).alias("has_differential"))


_SHIFT_SUMS = ("shift_count", "worked", "overtime", "extended_shifts_count",
               "shifts_with_differential")


def _located(punches: DataFrame, workforce: DataFrame, keys: Sequence[str], roles: Rules,
             units: Rules) -> DataFrame:
    """Punch totals per ``keys`` and employee, with the employee's place and role.

    The punches are summed per employee before they meet the master.  The join
    is then one to one, an employee with very many punches is a single row per
    key in it, and heads can be counted as rows.
    """
    per_person = punches.groupBy("employee_int_id", *keys).agg(
        row_count().alias("shift_count"), F.sum("worked_minutes").alias("worked"),
        F.sum("overtime_minutes").alias("overtime"),
        F.count_if("is_extended_shift").alias("extended_shifts_count"),
        F.count_if("has_differential").alias("shifts_with_differential"))
    people = _classified_staff(workforce, roles, units)
    return per_person.join(people, "employee_int_id", "left").select(
        "employee_int_id", "employee_id", *keys, "department",
        F.coalesce("clinical_role", F.lit(OTHER_ROLE)).alias("clinical_role"),
        F.coalesce("care_unit_type", F.lit(OTHER_UNIT)).alias("care_unit_type"), *_SHIFT_SUMS)


def week_start(day: str) -> Column:
    return F.date_trunc("week", day).cast("date")


def _in_hours(minutes: Column) -> Column:
    return minutes.cast("double") / F.lit(60.0)


def shift_coverage(daily: DataFrame, workforce: DataFrame, *, roles: Rules = ROLE_RULES,
                   units: Rules = UNIT_RULES) -> DataFrame:
    """Coverage per week, month, department, shift and day type."""
    keys = ["week_start_date", "year_month", "shift_type", "day_type"]
    punches = (shift_punches(daily)
               .withColumn("week_start_date", week_start("attendance_date"))
               .withColumn("year_month", month_text("attendance_date")))
    grouped = (_located(punches, workforce, keys, roles, units).groupBy(*keys, "department")
               .agg(F.count("employee_int_id").alias("staff_count"),
                    *(F.sum(name).alias(name) for name in _SHIFT_SUMS)))
    worked, overtime, count = F.col("worked"), F.col("overtime"), F.col("shift_count")
    return grouped.select(
        "week_start_date", "year_month", "department", "shift_type", "day_type", "staff_count",
        "shift_count", round_to(_in_hours(worked), 2).alias("total_hours_worked"),
        nullable_ratio(_in_hours(worked), count, 2).alias("avg_hours_per_shift"),
        round_to(_in_hours(overtime), 2).alias("total_overtime_hours"),
        nullable_ratio(overtime, worked, 2, 100.0).alias("overtime_pct"),
        "extended_shifts_count", "shifts_with_differential",
        nullable_ratio(F.col("shifts_with_differential"), count, 2, 100.0)
        .alias("differential_pct"))


def clinical_workforce(staff: DataFrame) -> DataFrame:
    """Headcount, tenure and burnout per role, unit, department and employment status."""
    def mean(column: str) -> Column:
        return round_to(exact_mean(F.col(column).cast("decimal(18,2)")), 2)

    def risk(level: str) -> Column:
        return F.count_if(F.col("burnout_risk_level") == level)

    at_risk = F.count_if(F.col("burnout_risk_level").isin(HIGH, MODERATE))
    return staff.groupBy("clinical_role", "care_unit_type", "department",
                         "employment_status").agg(
        row_count().alias("staff_count"),
        F.count_if(F.col("employment_status") == "Active").alias("active_count"),
        mean("tenure_years").alias("avg_tenure_years"),
        F.count_if(F.col("tenure_years") < 1).alias("new_hires_under_1_year"),
        F.count_if(F.col("tenure_years") >= 5).alias("experienced_staff_5plus_years"),
        risk(HIGH).alias("high_burnout_risk_count"),
        risk(MODERATE).alias("moderate_burnout_risk_count"),
        nullable_ratio(at_risk, row_count(), 1, 100.0).alias("burnout_risk_pct"),
        mean("attendance_rate_pct").alias("avg_attendance_rate"),
        mean("overtime_percentage").alias("avg_overtime_pct"))


def staffing_ratios(daily: DataFrame, workforce: DataFrame, *,
                    minimum_staff: int = MINIMUM_STAFF, minimum_rns: int = MINIMUM_RNS,
                    roles: Rules = ROLE_RULES, units: Rules = UNIT_RULES) -> DataFrame:
    """Weekly staffing levels per department and shift, from daily head counts."""
    keys = ["attendance_date", "shift_type"]
    people = _located(shift_punches(daily), workforce, keys, roles, units)
    known = F.col("employee_int_id").isNotNull()

    def heads(role: str) -> Column:
        return F.count_if(known & (F.col("clinical_role") == role))

    daily_heads = people.groupBy(*keys, "department", "care_unit_type").agg(
        F.count_if(known).alias("staff"), heads(RN).alias("rns"), heads(LPN).alias("lpns"),
        heads(CNA).alias("cnas"))
    week = week_start("attendance_date")
    days = row_count()
    return (daily_heads.groupBy(week.alias("week_start_date"), "department", "care_unit_type",
                                "shift_type")
            .agg(days.alias("days"),
                 round_to(exact_mean("staff"), 2).alias("avg_total_staff_count"),
                 F.min("staff").alias("min_total_staff_count"),
                 F.max("staff").alias("max_total_staff_count"),
                 round_to(exact_mean("rns"), 2).alias("avg_rn_count"),
                 F.min("rns").alias("min_rn_count"),
                 round_to(exact_mean("lpns"), 2).alias("avg_lpn_count"),
                 round_to(exact_mean("cnas"), 2).alias("avg_cna_count"),
                 nullable_ratio(F.count_if(F.col("staff") < minimum_staff), days, 1, 100.0)
                 .alias("understaffed_days_pct"),
                 F.count_if((F.col("care_unit_type") == ICU) & (F.col("rns") < minimum_rns))
                 .alias("days_below_min_rn_icu"),
                 round_to(F.stddev_samp("staff"), 2).alias("staff_count_stddev"))
            .withColumn("year", F.year("week_start_date").cast("long"))
            .withColumn("month", F.month("week_start_date").cast("long")))


# Reports over the frames above.

def _active(frame: DataFrame) -> DataFrame:
    return frame.where(F.col("employment_status") == "Active")


def _mean(column: str, digits: int = 1) -> Column:
    return round_to(exact_mean(F.col(column).cast("decimal(18,2)")), digits)


def _total(column: str) -> Column:
    return round_to(F.sum(F.col(column).cast("decimal(18,2)")), 2)


def staff_distribution(staff: DataFrame, k: int = 15) -> DataFrame:
    groups = staff.groupBy("clinical_role", "care_unit_type").agg(
        row_count().alias("staff_count"),
        F.count_if(F.col("employment_status") == "Active").alias("active_count"),
        _mean("tenure_years").alias("avg_tenure_years"),
        _mean("attendance_rate_pct").alias("avg_attendance_rate"))
    return top_k(groups, [*descending("staff_count"),
                          *ascending("clinical_role", "care_unit_type")], k)


def burnout_groups(staff: DataFrame, minimum_hours: float = 50.0, k: int = 15) -> DataFrame:
    groups = _active(staff).groupBy("clinical_role", "department").agg(
        row_count().alias("staff_count"),
        _mean("ytd_overtime_hours").alias("avg_overtime_hours"),
        _mean("overtime_percentage").alias("avg_overtime_pct"),
        F.count_if(F.col("burnout_risk_level") == HIGH).alias("high_risk_count"),
        F.count_if(F.col("burnout_risk_level") == MODERATE).alias("moderate_risk_count"),
        exact_mean(F.col("ytd_overtime_hours").cast("decimal(18,2)")).alias("_mean_hours"))
    return top_k(groups.where(F.col("_mean_hours") > minimum_hours).drop("_mean_hours"),
                 [*descending("avg_overtime_hours"), *ascending("clinical_role", "department")],
                 k)


def coverage_by_week(coverage: DataFrame, as_of: dt.date, weeks: int = 4) -> DataFrame:
    since = F.lit(as_of - dt.timedelta(weeks=weeks))
    return (coverage.where(F.col("week_start_date") >= since)
            .groupBy("week_start_date", "shift_type")
            .agg(F.sum("staff_count").alias("total_staff"),
                 _mean("avg_hours_per_shift").alias("avg_hours_per_shift"),
                 _total("total_overtime_hours").alias("total_overtime_hours"),
                 _mean("overtime_pct").alias("avg_overtime_pct"),
                 F.sum("extended_shifts_count").alias("extended_shifts"))
            .orderBy(*descending("week_start_date"), *ascending("shift_type"))
            .select(F.date_format("week_start_date", "yyyy-MM-dd").alias("week"), "shift_type",
                    "total_staff", "avg_hours_per_shift", "total_overtime_hours",
                    "avg_overtime_pct", "extended_shifts"))


def staffing_this_month(ratios: DataFrame, as_of: dt.date) -> DataFrame:
    def shown(column: str, name: str) -> Column:
        return F.round(column, 1).alias(name)

    return (ratios.where((F.col("year") == as_of.year) & (F.col("month") == as_of.month))
            .select("department", "shift_type", "week_start_date",
                    shown("avg_rn_count", "avg_rns"), shown("avg_lpn_count", "avg_lpns"),
                    shown("avg_cna_count", "avg_cnas"),
                    shown("avg_total_staff_count", "avg_total_staff"),
                    F.col("min_total_staff_count").alias("min_staff"),
                    F.col("max_total_staff_count").alias("max_staff"),
                    F.col("understaffed_days_pct").alias("pct_understaffed_days"))
            .orderBy(*ascending("department", "shift_type", "week_start_date")))


def critical_care_summary(metrics: DataFrame) -> DataFrame:
    return (_active(metrics).where(F.col("care_unit_type").isin(*CRITICAL_UNITS))
            .select("care_unit_type", "clinical_role", "department", "staff_count",
                    "active_count", F.round("avg_tenure_years", 1).alias("avg_tenure"),
                    F.round("avg_attendance_rate", 1).alias("attendance_rate"),
                    "high_burnout_risk_count",
                    F.round("avg_overtime_pct", 1).alias("avg_overtime_pct"))
            .orderBy(*ascending("care_unit_type"), *descending("staff_count"),
                     *ascending("clinical_role", "department")))


def differential_pay(coverage: DataFrame, year_month: str) -> DataFrame:
    return (coverage.where(F.col("year_month") == year_month)
            .groupBy("shift_type", "day_type")
            .agg(F.sum("staff_count").alias("total_staff"),
                 _total("total_hours_worked").alias("total_hours"),
                 F.sum("shifts_with_differential").alias("differential_shifts"),
                 _mean("differential_pct").alias("avg_differential_pct"))
            .orderBy(*ascending("shift_type", "day_type")))


def turnover_indicators(metrics: DataFrame, minimum_staff: int = 5, k: int = 15) -> DataFrame:
    count = F.col("staff_count")
    rows = _active(metrics).where(count >= minimum_staff).select(
        "clinical_role", "care_unit_type", "department", "staff_count",
        "new_hires_under_1_year", "experienced_staff_5plus_years",
        nullable_ratio(F.col("new_hires_under_1_year"), count, 1, 100.0).alias("new_hire_pct"),
        nullable_ratio(F.col("experienced_staff_5plus_years"), count, 1, 100.0)
        .alias("experienced_pct"))
    return top_k(rows, [*descending("new_hire_pct"),
                        *ascending("clinical_role", "care_unit_type", "department")], k)


def new_hire_share(metrics: DataFrame) -> DataFrame:
    return (_active(metrics).select(
        "clinical_role", "care_unit_type", "department", "staff_count",
        "new_hires_under_1_year",
        nullable_ratio(F.col("new_hires_under_1_year"), F.col("staff_count"), 1, 100.0)
        .alias("new_hire_pct"))
        .orderBy(*descending("new_hire_pct"),
                 *ascending("clinical_role", "care_unit_type", "department")))


def burnout_by_department(metrics: DataFrame, minimum_percent: float = 20.0) -> DataFrame:
    return (_active(metrics).where(F.col("burnout_risk_pct") > minimum_percent)
            .select("department", "clinical_role", "care_unit_type", "staff_count",
                    "high_burnout_risk_count", "moderate_burnout_risk_count",
                    "burnout_risk_pct")
            .orderBy(*descending("burnout_risk_pct"),
                     *ascending("department", "clinical_role", "care_unit_type")))


def icu_nurses_at_risk(staff: DataFrame) -> DataFrame:
    return (staff.where((F.col("clinical_role") == RN) & (F.col("care_unit_type") == ICU)
                        & F.col("burnout_risk_level").isin(HIGH, MODERATE))
            .select("full_name", "department", "ytd_overtime_hours", "burnout_risk_level")
            .orderBy(*descending("ytd_overtime_hours"), *ascending("full_name")))


def active_staff_by_role(staff: DataFrame) -> DataFrame:
    return _active(staff).groupBy("clinical_role", "care_unit_type").agg(
        row_count().alias("staff_count"))


def night_shift_staffing(daily: DataFrame, workforce: DataFrame, as_of: dt.date,
                         days: int = 7, *, roles: Rules = ROLE_RULES,
                         units: Rules = UNIT_RULES) -> DataFrame:
    since = F.lit(as_of - dt.timedelta(days=days))
    nights = shift_punches(daily.where(F.col("attendance_date") >= since)).where(
        F.col("shift_type") == NIGHT)
    return (_located(nights, workforce, ["attendance_date"], roles, units)
            .groupBy("attendance_date", "department")
            .agg(F.sum("shift_count").alias("staff_count"),
                 round_to(_in_hours(F.sum("worked")), 2).alias("total_hours"),
                 round_to(_in_hours(F.sum("overtime")), 2).alias("total_overtime"))
            .orderBy(*descending("attendance_date"), *ascending("department")))


def weekend_coverage(daily: DataFrame, workforce: DataFrame, as_of: dt.date, days: int = 30, *,
                     roles: Rules = ROLE_RULES, units: Rules = UNIT_RULES) -> DataFrame:
    since = F.lit(as_of - dt.timedelta(days=days))
    weekends = shift_punches(daily.where(F.col("attendance_date") >= since)).where(
        F.col("day_type") == "Weekend")
    return (_located(weekends, workforce, [], roles, units)
            .groupBy("department").agg(distinct_count("employee_id").alias("unique_staff")))


def monthly_coverage(coverage: DataFrame) -> DataFrame:
    return (coverage.groupBy("year_month", "department", "shift_type")
            .agg(_mean("staff_count", 2).alias("avg_staff"),
                 _mean("overtime_pct", 2).alias("avg_overtime_pct"))
            .orderBy(*descending("year_month"), *ascending("department", "shift_type")))


def high_overtime_weeks(coverage: DataFrame, minimum_percent: float = 15.0) -> DataFrame:
    mean = exact_mean(F.col("overtime_pct").cast("decimal(18,2)"))
    return (coverage.groupBy("week_start_date", "shift_type")
            .agg(_total("total_overtime_hours").alias("total_ot"), mean.alias("_mean"))
            .where(F.col("_mean") > minimum_percent)
            .select("week_start_date", "shift_type", "total_ot",
                    round_to(F.col("_mean"), 2).alias("avg_ot_pct"))
            .orderBy(*descending("total_ot"), *ascending("week_start_date", "shift_type")))


def icu_compliance(ratios: DataFrame, as_of: dt.date, weeks: int = 4) -> DataFrame:
    since = F.lit(as_of - dt.timedelta(weeks=weeks))
    return (ratios.where(F.col("department").like("%ICU%") & (F.col("week_start_date") >= since))
            .select("week_start_date", "department", "shift_type", "avg_rn_count",
                    "min_rn_count", "days_below_min_rn_icu")
            .orderBy(*descending("week_start_date"), *ascending("department", "shift_type")))


def understaffed_shifts(ratios: DataFrame, as_of: dt.date,
                        minimum_percent: float = 10.0) -> DataFrame:
    return (ratios.where((F.col("year") == as_of.year)
                         & (F.col("understaffed_days_pct") > minimum_percent))
            .select("department", "shift_type", "week_start_date", "avg_total_staff_count",
                    "min_total_staff_count", "understaffed_days_pct")
            .orderBy(*descending("understaffed_days_pct"),
                     *ascending("department", "shift_type", "week_start_date")))


def rn_shortfalls(ratios: DataFrame, minimum_rns: int = MINIMUM_RNS) -> DataFrame:
    return ratios.where((F.col("care_unit_type") == ICU)
                        & (F.col("min_rn_count") < minimum_rns))


def differential_hours(coverage: DataFrame, year_month: str) -> DataFrame:
    each = (F.col("shifts_with_differential")
            * F.col("avg_hours_per_shift").cast("decimal(18,2)"))
    return (coverage.where(F.col("year_month") == year_month)
            .groupBy("shift_type", "day_type")
            .agg(round_to(F.sum(each), 2).alias("differential_hours")))


def retention_risks(staff: DataFrame, minimum_attendance: float = 90.0) -> DataFrame:
    return (staff.where((F.col("burnout_risk_level") == HIGH)
                        | (F.col("attendance_rate_pct") < minimum_attendance))
            .select("employee_int_id", "full_name", "department", "clinical_role",
                    "ytd_overtime_hours", "burnout_risk_level", "attendance_rate_pct")
            .orderBy(*descending("ytd_overtime_hours"),
                     *ascending("full_name", "employee_int_id")))


def variable_shifts(ratios: DataFrame, minimum_stddev: float = 2.0) -> DataFrame:
    return (ratios.where(F.col("staff_count_stddev") > minimum_stddev)
            .select("department", "shift_type", "week_start_date", "staff_count_stddev",
                    "min_total_staff_count", "max_total_staff_count")
            .orderBy(*descending("staff_count_stddev"),
                     *ascending("department", "shift_type", "week_start_date")))
