"""The views wired together over one set of raw tables.

``WorkforceModel`` only composes the functions of :mod:`rosterloom.plans`; every
view is a lazy frame, and a raw table is opened when a view first needs it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property
from typing import Protocol

from pyspark.sql import DataFrame, functions as F

from rosterloom.operators import top_k_of_many
from rosterloom.operators.workforce import Grain
from rosterloom.plans import alerts, business, healthcare, kpis, metrics, reports, staging


class RawTables(Protocol):
    activity_log: DataFrame
    attendance: Mapping[str, DataFrame]
    thr_attendance: DataFrame
    tppd_dept: DataFrame
    crmc_payrollfile: DataFrame
    tpp_tc_main: DataFrame
    workforcetable_rpt: DataFrame


# View names by tier, in the order they build on each other.
VIEWS = {
    "staging": ("stg_activity_log", "stg_attendance", "stg_daily_attendance", "stg_departments",
                "stg_employees", "stg_payroll", "stg_payroll_main", "stg_workforce"),
    "business": ("attendance_detail", "daily_attendance_detail", "employee_summary",
                 "payroll_analytics", "payroll_detail", "clinical_staff_summary",
                 "staffing_by_shift", "workforce_demographics"),
    "metrics": ("attendance_daily_metrics", "attendance_metrics", "clinical_workforce_metrics",
                "department_staffing_ratios", "executive_alerts", "executive_kpis",
                "headcount_metrics", "monthly_payroll_metrics", "payroll_period_metrics",
                "shift_coverage_metrics", "workforce_metrics"),
    "healthcare": ("clinical_staff", "shift_punches", "shift_coverage", "clinical_workforce",
                   "staffing_ratios"),
}


@dataclass(frozen=True, eq=False)
class WorkforceModel:
    """All views as of one reporting day.

    ``workforce_grain="latest"`` joins facts to one master row per employee
    instead of to every snapshot.
    """

    raw: RawTables
    as_of: dt.date
    loaded_at: dt.datetime | None = None
    workforce_grain: Grain = "snapshot"

    # Staging.

    @cached_property
    def stg_activity_log(self) -> DataFrame:
        return staging.stg_activity_log(self.raw.activity_log, self.loaded_at)

    @cached_property
    def stg_attendance(self) -> DataFrame:
        return staging.stg_attendance(self.raw.attendance, self.loaded_at)

    @cached_property
    def stg_daily_attendance(self) -> DataFrame:
        return staging.stg_daily_attendance(self.raw.thr_attendance, self.loaded_at)

    @cached_property
    def stg_departments(self) -> DataFrame:
        return staging.stg_departments(self.raw.tppd_dept, self.loaded_at)

    @cached_property
    def stg_employees(self) -> DataFrame:
        return staging.stg_employees(self.raw.crmc_payrollfile, self.loaded_at)

    @cached_property
    def stg_payroll(self) -> DataFrame:
        return staging.stg_payroll(self.raw.crmc_payrollfile, self.loaded_at)

    @cached_property
    def stg_payroll_main(self) -> DataFrame:
        return staging.stg_payroll_main(self.raw.tpp_tc_main, self.loaded_at)

    @cached_property
    def stg_workforce(self) -> DataFrame:
        return staging.stg_workforce(self.raw.workforcetable_rpt, self.loaded_at)

    # Business.

    def attendance_detail(self, *, ordered: bool = False) -> DataFrame:
        return business.attendance_detail(self.stg_attendance, ordered=ordered)

    def daily_attendance_detail(self, *, since: dt.date | None = None,
                                until: dt.date | None = None) -> DataFrame:
        return business.daily_attendance_detail(
            _between(self.stg_daily_attendance, "attendance_date", since, until),
            self.stg_workforce, workforce_grain=self.workforce_grain)

    def employee_summary(self) -> DataFrame:
        return business.employee_summary(self.stg_payroll)

    def payroll_analytics(self, *, since: dt.date | None = None, until: dt.date | None = None,
                          latest_only: bool = False, highest: int | None = None) -> DataFrame:
        """``latest_only``: the newest month; ``highest``: the cheques of so many highest gross
        amounts, ties included.  The join to the master drops no row, so both cut before it."""
        pay = _between(self.stg_payroll_main, "pay_date", since, until)
        if latest_only:
            pay = in_latest_month(pay)
        if highest is not None:
            pay = among_highest(pay, "gross_pay", highest)
        return business.payroll_analytics(pay, self.stg_workforce, workforce_grain=self.workforce_grain)

    def payroll_detail(self, *, ordered: bool = False) -> DataFrame:
        return business.payroll_detail(self.stg_payroll, ordered=ordered)

    def clinical_staff_summary(self, *, ordered: bool = False) -> DataFrame:
        return business.clinical_staff_summary(self.employee_summary(), ordered=ordered)

    def staffing_by_shift(self, *, ordered: bool = False) -> DataFrame:
        return business.staffing_by_shift(self.stg_attendance, ordered=ordered)

    def workforce_demographics(self) -> DataFrame:
        return business.workforce_demographics(self.stg_workforce, self.as_of)

    # Metrics.  ``since`` and ``until`` restrict the facts before they are
    # aggregated: on the date itself, so that the scan can skip files.

    def attendance_daily_metrics(self, *, since: dt.date | None = None,
                                 until: dt.date | None = None, newest_months: int | None = None,
                                 ordered: bool = False) -> DataFrame:
        daily = _between(self.stg_daily_attendance, "attendance_date", since, until)
        if newest_months is not None:
            daily = in_newest_months(daily, "attendance_date", newest_months)
        return metrics.attendance_daily_metrics(
            daily, self.stg_workforce, workforce_grain=self.workforce_grain,
            calculated_at=self.loaded_at, ordered=ordered)

    def attendance_metrics(self, *, ordered: bool = False) -> DataFrame:
        return metrics.attendance_metrics(self.stg_attendance, ordered=ordered)

    def clinical_workforce_metrics(self, *, ordered: bool = False) -> DataFrame:
        return metrics.clinical_workforce_metrics(self.employee_summary(), ordered=ordered)

    def department_staffing_ratios(self, *, ordered: bool = False) -> DataFrame:
        return metrics.department_staffing_ratios(self.staffing_by_shift(), ordered=ordered)

    def executive_alerts(self, *, ordered: bool = False) -> DataFrame:
        return alerts.executive_alerts(
            self.stg_payroll, self.stg_daily_attendance, self.stg_workforce, self.as_of,
            detected_at=self.loaded_at, workforce_grain=self.workforce_grain, ordered=ordered)

    def chronic_lateness(self) -> DataFrame:
        return alerts.chronic_lateness(self.stg_daily_attendance, self.stg_workforce, self.as_of,
                                       workforce_grain=self.workforce_grain)

    def department_absence(self) -> DataFrame:
        return alerts.department_absence(self.stg_daily_attendance, self.stg_workforce, self.as_of,
                                         workforce_grain=self.workforce_grain)

    def excessive_overtime(self) -> DataFrame:
        return alerts.excessive_overtime(self.stg_daily_attendance, self.stg_workforce, self.as_of,
                                         workforce_grain=self.workforce_grain)

    def executive_kpis(self) -> DataFrame:
        return kpis.executive_kpis(self.stg_workforce, self.stg_daily_attendance,
                                   self.stg_payroll_main, self.as_of,
                                   calculated_at=self.loaded_at)

    def headcount_metrics(self, *, ordered: bool = False) -> DataFrame:
        return metrics.headcount_metrics(self.stg_payroll, ordered=ordered)

    def monthly_payroll_metrics(self, *, ordered: bool = False) -> DataFrame:
        return metrics.monthly_payroll_metrics(self.stg_payroll, ordered=ordered)

    def payroll_period_metrics(self, *, since: dt.date | None = None,
                               until: dt.date | None = None,
                               latest_only: bool = False, newest_months: int | None = None,
                               ordered: bool = False) -> DataFrame:
        pay = _between(self.stg_payroll_main, "pay_date", since, until)
        if latest_only:
            pay = in_latest_month(pay)
        if newest_months is not None:
            pay = in_newest_months(pay, "pay_date", newest_months)
        return metrics.payroll_period_metrics(
            pay, self.stg_workforce, workforce_grain=self.workforce_grain,
            calculated_at=self.loaded_at, ordered=ordered)

    def monthly_overtime(self, newest_pay_months: int) -> DataFrame:
        """Overtime hours of the months from the first of the newest pay months on."""
        return reports.monthly_overtime(in_newest_months(
            self.stg_daily_attendance, "attendance_date", newest_pay_months,
            dates=self.stg_payroll_main, of="pay_date"))

    def department_headcount(self, newest_months: int) -> DataFrame:
        return reports.department_headcount(
            in_newest_months(self.stg_daily_attendance, "attendance_date", newest_months),
            self.stg_workforce, self.workforce_grain)

    def shift_coverage_metrics(self, *, ordered: bool = False) -> DataFrame:
        return metrics.shift_coverage_metrics(self.staffing_by_shift(), ordered=ordered)

    def workforce_metrics(self, *, ordered: bool = False) -> DataFrame:
        return metrics.workforce_metrics(self.stg_workforce, self.as_of,
                                         calculated_at=self.loaded_at, ordered=ordered)

    # Healthcare.

    def clinical_staff(self, **rules) -> DataFrame:
        return healthcare.clinical_staff(self.stg_workforce, self.stg_daily_attendance,
                                         self.as_of, **rules)

    def clinical_workforce(self) -> DataFrame:
        return healthcare.clinical_workforce(self.clinical_staff())

    def shift_punches(self) -> DataFrame:
        return healthcare.shift_punches(self.stg_daily_attendance)

    def shift_coverage(self, *, since: dt.date | None = None, until: dt.date | None = None,
                       **rules) -> DataFrame:
        return healthcare.shift_coverage(
            _between(self.stg_daily_attendance, "attendance_date", since, until),
            self.stg_workforce, **rules)

    def staffing_ratios(self, *, since: dt.date | None = None, until: dt.date | None = None,
                        **rules) -> DataFrame:
        return healthcare.staffing_ratios(
            _between(self.stg_daily_attendance, "attendance_date", since, until),
            self.stg_workforce, **rules)

    # Access by name.

    def view(self, name: str) -> DataFrame:
        """A view by its bare or ``tier.``-qualified name."""
        tier, _, bare = name.rpartition(".")
        known = VIEWS.get(tier, ()) if tier else tuple(n for names in VIEWS.values() for n in names)
        if bare not in known:
            raise KeyError(f"no view named {name!r}")
        found = getattr(self, bare)
        return found() if callable(found) else found

    def register(self) -> None:
        """Every view as a temporary view of its bare name, for ``spark.sql``."""
        for names in VIEWS.values():
            for name in names:
                self.view(name).createOrReplaceTempView(name)


def _between(frame: DataFrame, column: str, since: dt.date | None,
             until: dt.date | None) -> DataFrame:
    if since is not None:
        frame = frame.where(F.col(column) >= F.lit(since))
    if until is not None:
        frame = frame.where(F.col(column) <= F.lit(until))
    return frame


def in_newest_months(frame: DataFrame, column: str, k: int, *, dates: DataFrame | None = None,
                     of: str | None = None) -> DataFrame:
    """Rows of the ``k`` newest months of ``column`` (or of ``of`` in ``dates``), found by a
    one-column scalar subquery.

    The range on the column itself reaches the scan.  Undated rows go; all others stay, if there are fewer months.
    """
    source, day = (frame, column) if dates is None else (dates, of or column)
    months = source.where(F.col(day).isNotNull()).select(F.trunc(day, "MM").alias("m")).distinct()
    newest = months.orderBy(F.desc("m")).limit(k)
    first = newest.agg(F.coalesce(F.when(F.count("m") == k, F.min("m")), F.expr("DATE'0001-01-01'"))).scalar()
    return frame.where(F.col(column) >= first)


def in_latest_month(pay: DataFrame) -> DataFrame:
    newest = pay.agg(F.trunc(F.max("pay_date"), "MM")).scalar()
    return pay.where(F.col("pay_date") >= newest)


def among_highest(frame: DataFrame, column: str, k: int) -> DataFrame:
    """Rows whose ``column`` is one of its ``k`` highest, with all ties; all rows, if fewer have one."""
    highest = top_k_of_many(frame.where(F.col(column).isNotNull()).select(column), [F.desc(column)], k)
    least = highest.agg(F.when(F.count(column) == k, F.min(column))).scalar()
    return frame.where(F.coalesce(F.col(column) >= least, least.isNull()))
