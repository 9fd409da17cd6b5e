"""Named queries over the star-schema Parquet files: one per operator.

Keys are the operator ids of the survey with the operator's name.  Every query
reads whole tables; the parameters are those of the operators themselves.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType, TimestampType

from rosterloom.functions import row_count
from rosterloom.model import WorkforceModel
from rosterloom.operators import join_bucketed, join_split, workforce_dimension
from rosterloom.operators.workforce import KEY, Grain
from rosterloom.plans import alerts, business, healthcare as hc, kpis, metrics, reports, staging
from rosterloom.session import limit_methods
from rosterloom.sources import conform, incremental, ingest, keyed, materialize, quality
from rosterloom.sources.schemas import raw_schema
from rosterloom.sources.scratch import fresh_database
from rosterloom.sources.starschema import ACTIVITY_AS_OF, AS_OF, StarSchemaTables

Query = Callable[[SparkSession, str], DataFrame]

LOADED_AT = dt.datetime(2001, 8, 1, 12)
WINDOW = (AS_OF - dt.timedelta(days=30), AS_OF)
MONTH = AS_OF.replace(day=1) - dt.timedelta(days=1)
YEAR_MONTH = MONTH.strftime("%Y-%m")
THIS_MONTH = AS_OF.strftime("%Y-%m")
# Rows of an import's window end here, and it looks back this far.
IMPORT_NOW = dt.datetime.combine(ACTIVITY_AS_OF, dt.time())
IMPORT_DAYS = 30

_STAMPS = ("_loaded_at", "last_updated", "detected_at", "calculated_at", "check_time")


# Columns that do hold nulls, by query: clients disagree on how a whole number or a
# flag next to a null looks, so these go out as text.
HOLDS_NULLS: dict[str, tuple[str, ...]] = {
    "a1_import_table": ("Activity_Id",),
    "a1_import_window": ("Activity_Id",),
    "a2_recent_window": ("Activity_Id",),
    "a2_window_history": ("Activity_Id",),
    "a3_clean_columns": ("arrears_assigned_yn", "Age"),
    "b2_stg_attendance": ("shift_diff_flag",),
    "b3_stg_daily_attendance": ("attendance_id", "attendance_status_id", "employee_int_id"),
    "b6_stg_payroll": ("age", "arrears_assigned"),
    "b6_stg_payroll_from_text": ("age", "arrears_assigned"),
    "s12_accepted_rows": ("age", "arrears_assigned"),
    "b7_stg_payroll_main": ("payroll_work_id",),
    "c1_attendance_detail": ("shift_diff_flag",),
    "c2_daily_attendance_detail": ("attendance_id", "employee_int_id"),
    "c2_daily_attendance_bucketed": ("attendance_id", "employee_int_id"),
    "c2_daily_attendance_split": ("attendance_id", "employee_int_id"),
    "c4_payroll_analytics": ("payroll_work_id",),
    "c5_payroll_detail": ("age", "arrears_assigned"),
    "c8_workforce_demographics": ("age", "tenure_years"),
    "e12_employee_details": ("tenure_years",),
    "e12_employee_details_filtered": ("tenure_years",),
    "h3_clinical_staff": ("tenure_years",),
}


def comparable(frame: DataFrame, holds_nulls: Collection[str] = ()) -> DataFrame:
    """The frame in types any engine's client renders alike, without load times.

    Whole numbers as BIGINT, decimals as DOUBLE, dates as ISO text, timestamps
    without zone, and columns of ``holds_nulls`` as text.
    """
    def plain(field):
        column = F.col(f"`{field.name}`")
        if field.name in holds_nulls:
            column = column.cast("string")
        elif isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, IntegralType):
            column = column.cast("long")
        elif isinstance(field.dataType, DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        return column.alias(field.name)

    return frame.select(*(plain(f) for f in frame.schema.fields if f.name not in _STAMPS))


def model_of(spark: SparkSession, directory: str, grain: Grain = "snapshot") -> WorkforceModel:
    return WorkforceModel(StarSchemaTables(spark, directory), AS_OF, LOADED_AT, grain)


def _monday_on_or_after(day: dt.date) -> dt.date:
    return day + dt.timedelta(days=-day.weekday() % 7)


# Imports, logs and materialisation: the queries write tables and read them back.

def _activity_job(spark: SparkSession, directory: str, days_back: int | None) -> ingest.ImportJob:
    return ingest.ImportJob("Activity-Log", lambda: StarSchemaTables(spark, directory).activity_log,
                            "EnteredDate", days_back)


def _import_activity(spark: SparkSession, directory: str, purpose: str,
                     days_back: int | None = IMPORT_DAYS) -> str:
    database = fresh_database(spark, purpose)
    ingest.import_table(spark, _activity_job(spark, directory, days_back), database=database,
                        log_table=f"{database}.import_log", now=IMPORT_NOW)
    return database


def import_table(spark: SparkSession, directory: str) -> DataFrame:
    """The whole log, reloaded."""
    database = _import_activity(spark, directory, "import_full", None)
    return spark.table(f"{database}.activity_log")


def import_window(spark: SparkSession, directory: str) -> DataFrame:
    """The last days of the log, reloaded."""
    return spark.table(f"{_import_activity(spark, directory, 'import_window')}.activity_log")


def import_log(spark: SparkSession, directory: str) -> DataFrame:
    database = _import_activity(spark, directory, "import_log")
    return _bare_names(spark.table(f"{database}.import_log")).drop("imported_at")


def _bare_names(statuses: DataFrame) -> DataFrame:
    return statuses.withColumn("table_name", F.substring_index("table_name", ".", -1))


def import_many(spark: SparkSession, directory: str) -> DataFrame:
    """Three imports of which one source does not exist."""
    database, raw = fresh_database(spark, "import_many"), StarSchemaTables(spark, directory)
    jobs = [_activity_job(spark, directory, IMPORT_DAYS),
            ingest.ImportJob("1099 Missing$", lambda: raw.read("no_such_table")),
            ingest.ImportJob("TPPD Dept", lambda: raw.tppd_dept)]
    statuses = ingest.import_many(spark, jobs, database=database,
                                  log_table=f"{database}.import_log", now=IMPORT_NOW)
    return _bare_names(statuses).select(
        "table_name", "row_count", F.substring_index("status", ":", 1).alias("status"))


def _synced(spark: SparkSession, directory: str, purpose: str) -> tuple[str, DataFrame]:
    database = fresh_database(spark, purpose)
    source = StarSchemaTables(spark, directory).crmc_payrollfile
    ingest.sync_table(spark, source, f"{database}.benefits",
                      log_table=f"{database}.freshness", now=IMPORT_NOW)
    return database, source


def sync_table(spark: SparkSession, directory: str) -> DataFrame:
    database, _ = _synced(spark, directory, "sync")
    log = ingest.latest_per(spark.table(f"{database}.freshness"), "table_name", "checked_at")
    return _bare_names(log).drop("checked_at")


def row_parity(spark: SparkSession, directory: str) -> DataFrame:
    database, source = _synced(spark, directory, "parity")
    return ingest.parity(source, spark.table(f"{database}.benefits"), "benefits")


def recent_window(spark: SparkSession, directory: str) -> DataFrame:
    raw = StarSchemaTables(spark, directory).activity_log
    return ingest.recent(raw, "EnteredDate", IMPORT_DAYS, IMPORT_NOW)


def clean_columns(spark: SparkSession, directory: str) -> DataFrame:
    """Every benefits line under cleaned names."""
    return ingest.clean_column_names(StarSchemaTables(spark, directory).crmc_payrollfile)


def quality_report(spark: SparkSession, directory: str) -> DataFrame:
    model = model_of(spark, directory)
    daily, workforce = "stg_daily_attendance", "stg_workforce"
    return quality.checked({
        daily: quality.TableChecks(
            model.stg_daily_attendance, not_null=("attendance_id", "attendance_date"), unique=(("attendance_id",),),
            referential=(("employee_int_id", workforce, "employee_int_id"),), same_rows=("thr_attendance",)),
        workforce: quality.TableChecks(model.stg_workforce, unique=(("employee_int_id", "tcpaydt_int_id"),)),
        "thr_attendance": quality.TableChecks(model.raw.thr_attendance),
    })


def _text_feed(spark: SparkSession, directory: str) -> DataFrame:
    """The benefits file as text, with some values that will not cast."""
    raw = StarSchemaTables(spark, directory).crmc_payrollfile
    pp, text = F.col("No of PP"), [F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns]
    spoiled = {"Age": (pp == 7, "n/a"), "Total Arrears": (pp == 6, "12,5"), "arrears_assigned_yn": (pp == 5, "maybe")}
    return raw.select(*(F.when(spoiled[c][0], F.lit(spoiled[c][1])).otherwise(t).alias(c) if c in spoiled else t
                        for c, t in zip(raw.columns, text)))


def uncastable_values(spark: SparkSession, directory: str) -> DataFrame:
    return conform.uncastable(_text_feed(spark, directory), "crmc_payrollfile", raw_schema("crmc_payrollfile"))


def staged_text_feed(spark: SparkSession, directory: str) -> DataFrame:
    """The benefits view over text, with nulls for what will not cast."""
    raw = conform.conform(_text_feed(spark, directory), raw_schema("crmc_payrollfile"), "null")
    return staging.stg_payroll(raw, LOADED_AT)


def _quarantined(spark: SparkSession, directory: str, purpose: str) -> str:
    target = f"{fresh_database(spark, purpose)}.benefits"
    conform.quarantine(_text_feed(spark, directory), target, raw_schema("crmc_payrollfile"))
    return target


def accepted_rows(spark: SparkSession, directory: str) -> DataFrame:
    """The benefits view over those rows of the text feed of which all values cast."""
    raw = conform.accepted(spark, _quarantined(spark, directory, "accepted"))
    return staging.stg_payroll(raw, LOADED_AT)


def rejected_rows(spark: SparkSession, directory: str) -> DataFrame:
    """The other rows, as delivered, with their failing columns."""
    raw = conform.rejected(spark, _quarantined(spark, directory, "rejected"))
    return raw.select(
        F.col("Employee ID").alias("employee_id"), F.col("emp_Int_id").alias("employee_int_id"),
        F.col("No of PP").alias("num_pay_periods"), F.col("Age").alias("age"), F.col("Total Arrears").alias("total_arrears"),
        F.col("arrears_assigned_yn").alias("arrears_assigned"), F.array_join("_failed", ",").alias("failed"))


def keyed_employees(spark: SparkSession, directory: str) -> DataFrame:
    """An employee list that starts out of date and incomplete, is brought up to date by key, and loses some people."""
    name = f"{fresh_database(spark, 'keyed')}.employees"
    people = model_of(spark, directory).stg_employees.drop("_loaded_at")
    key, number = ["employee_id", "employee_int_id"], F.col("employee_int_id").cast("long")
    old = people.where(number % 3 != 0).withColumn("last_name", F.when(number % 2 == 0, F.lit("?")).otherwise(F.col("last_name")))
    keyed.upsert(spark, name, old, key)
    keyed.upsert(spark, name, people.where((number % 3 == 0) | (number % 2 == 0)), key)
    keyed.delete(spark, name, people.where(number % 10 == 7), key)
    return spark.table(name)


def _clustered(spark: SparkSession, directory: str) -> DataFrame:
    """Daily metrics materialised by date, and the last 30 days read back: files of other days are skipped."""
    database = fresh_database(spark, "materialized_by_date")
    materialize.materialize(spark, model_of(spark, directory), "metrics.attendance_daily_metrics",
                            cache_database=database, log_table=f"{database}.materialized_views", now=IMPORT_NOW,
                            layout=ingest.TableLayout(cluster_by=("attendance_date", "department_name")))
    return spark.table(f"{database}.attendance_daily_metrics").where(
        F.col("attendance_date").between(F.lit(WINDOW[0]), F.lit(WINDOW[1])))


def _materialized(spark: SparkSession, directory: str, view: str) -> str:
    database = fresh_database(spark, f"materialized_{view.rpartition('.')[2]}")
    materialize.materialize(spark, model_of(spark, directory), view, cache_database=database,
                            log_table=f"{database}.materialized_views", now=IMPORT_NOW)
    return database


def materialized_view(spark: SparkSession, directory: str) -> DataFrame:
    database = _materialized(spark, directory, "employee_summary")
    return spark.table(f"{database}.employee_summary")


def refresh_log(spark: SparkSession, directory: str) -> DataFrame:
    database = _materialized(spark, directory, "metrics.headcount_metrics")
    return materialize.refreshes(spark, f"{database}.materialized_views").drop("last_refresh")


def window_history(spark: SparkSession, directory: str) -> DataFrame:
    """Two window imports, the first a window earlier; the days before the second's window stay."""
    database, raw = fresh_database(spark, "window_history"), StarSchemaTables(spark, directory).activity_log
    for now in (IMPORT_NOW - dt.timedelta(days=IMPORT_DAYS), IMPORT_NOW):
        ingest.import_days(raw, f"{database}.activity_log", "EnteredDate", IMPORT_DAYS, now)
    return spark.table(f"{database}.activity_log").drop("import_day")


BUCKET_ROWS = 500_000


def _bucketed(spark: SparkSession, directory: str, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Dated punches and their people, as tables in equal buckets of the employee.

    Unless given, there are at least 16 buckets and one for each ``BUCKET_ROWS`` lines, counted in the files' footers, so that a
    bucket's rows are sorted in memory however many there are.
    """
    model, database = model_of(spark, directory), fresh_database(spark, "bucketed")
    if buckets is None:
        buckets = max(16, -(-model.raw.read("lineitem").count() // BUCKET_ROWS))
    layout = ingest.TableLayout(bucket_by=(KEY,), buckets=buckets)
    people = workforce_dimension(model.stg_workforce, business.DETAIL_ATTRIBUTES)
    ingest.replace_table(model.stg_daily_attendance.select(*business.DETAIL_PUNCHES), f"{database}.punches", layout)
    ingest.replace_table(people, f"{database}.people", layout)
    punches = spark.table(f"{database}.punches")
    return punches.where(F.col("attendance_date").isNotNull()), spark.table(f"{database}.people")


def bucketed_detail(spark: SparkSession, directory: str) -> DataFrame:
    return business.daily_attendance_detail_of(join_bucketed(*_bucketed(spark, directory)))


def split_detail(model: WorkforceModel, most: int = 1_000_000) -> DataFrame:
    """Daily attendance with its frequent employees dealt over several tasks."""
    return business.daily_attendance_detail_of(join_split(
        model.stg_daily_attendance.where(F.col("attendance_date").isNotNull()),
        workforce_dimension(model.stg_workforce, business.DETAIL_ATTRIBUTES), ["attendance_id", "attendance_date"], most))


def _refreshed_twice(spark: SparkSession, facts: DataFrame, date_column: str, plan: incremental.DailyStates) -> DataFrame:
    """States by month after a first refresh that lacked some rows of each July, and a second of all."""
    late = (F.month(date_column) == 7) & (F.pmod(F.xxhash64(*(F.col(c) for c in facts.columns)), F.lit(2)) == 0)
    incremental.refresh(spark, facts.where(~F.coalesce(late, F.lit(False))), plan)
    incremental.refresh(spark, facts, plan)
    return spark.table(plan.table)


def incremental_daily(spark: SparkSession, directory: str) -> DataFrame:
    """Attendance per day and department from states of which the second refresh recomputes the changed months."""
    model, database = model_of(spark, directory), fresh_database(spark, "incremental_daily")
    workforce = model.stg_workforce.select("employee_int_id", *metrics.DEPARTMENT)
    facts = model.stg_daily_attendance.drop("_loaded_at")
    plan = incremental.DailyStates(lambda daily: metrics.attendance_states(daily, workforce), "attendance_date",
                                   "attendance_date", f"{database}.attendance_states", (workforce,), "MM")
    return metrics.attendance_daily_from(_refreshed_twice(spark, facts, "attendance_date", plan), calculated_at=LOADED_AT)


def incremental_periods(spark: SparkSession, directory: str) -> DataFrame:
    """Pay per month and department, merged from the states of single pay days."""
    model, database = model_of(spark, directory), fresh_database(spark, "incremental_periods")
    workforce = model.stg_workforce.select("employee_int_id", *metrics.DEPARTMENT)
    facts = model.stg_payroll_main.drop("_loaded_at")
    plan = incremental.DailyStates(lambda pay: metrics.payroll_states(pay, workforce, period="pay_date"), "pay_date",
                                   "pay_date", f"{database}.payroll_states", (workforce,), "MM")
    return metrics.payroll_period_from(_refreshed_twice(spark, facts, "pay_date", plan), calculated_at=LOADED_AT)


INGEST: dict[str, Query] = {
    "a1_import_table": import_table,
    "a1_import_window": import_window,
    "a2_recent_window": recent_window,
    "a2_window_history": window_history,
    "a3_clean_columns": clean_columns,
    "a4_import_many": import_many,
    "a5_sync_table": sync_table,
    "a6_import_log": import_log,
    "a7_row_parity": row_parity,
    "a8_quality_report": quality_report,
    "a8_uncastable_values": uncastable_values,
    "a9_keyed_employees": keyed_employees,
    "a9_materialized_view": materialized_view,
    "a9_materialized_window": _clustered,
    "a9_refresh_log": refresh_log,
    "a9_incremental_daily": incremental_daily,
    "a9_incremental_periods": incremental_periods,
    "b6_stg_payroll_from_text": staged_text_feed,
    "c2_daily_attendance_bucketed": bucketed_detail,
    "s12_accepted_rows": accepted_rows,
    "s12_rejected_rows": rejected_rows,
}

# Views.  Terminal outputs are sorted where the view is.

VIEW_QUERIES: dict[str, Callable[[WorkforceModel], DataFrame]] = {
    "b1_stg_activity_log": lambda m: m.stg_activity_log,
    "b2_stg_attendance": lambda m: m.stg_attendance,
    "b3_stg_daily_attendance": lambda m: m.stg_daily_attendance,
    "b4_stg_departments": lambda m: m.stg_departments,
    "b5_stg_employees": lambda m: m.stg_employees,
    "b6_stg_payroll": lambda m: m.stg_payroll,
    "b7_stg_payroll_main": lambda m: m.stg_payroll_main,
    "b8_stg_workforce": lambda m: m.stg_workforce,
    "c1_attendance_detail": lambda m: m.attendance_detail(ordered=True),
    "c2_daily_attendance_detail": lambda m: m.daily_attendance_detail(),
    "c2_daily_attendance_split": split_detail,
    "c3_employee_summary": lambda m: m.employee_summary(),
    "c4_payroll_analytics": lambda m: m.payroll_analytics(),
    "c5_payroll_detail": lambda m: m.payroll_detail(ordered=True),
    "c6_clinical_staff_summary": lambda m: m.clinical_staff_summary(ordered=True),
    "c7_staffing_by_shift": lambda m: m.staffing_by_shift(ordered=True),
    "c8_workforce_demographics": lambda m: m.workforce_demographics(),
    "d1_attendance_daily_metrics": lambda m: m.attendance_daily_metrics(ordered=True),
    "d2_attendance_metrics": lambda m: m.attendance_metrics(ordered=True),
    "d3_clinical_workforce_metrics": lambda m: m.clinical_workforce_metrics(ordered=True),
    "d4_department_staffing_ratios": lambda m: m.department_staffing_ratios(ordered=True),
    "d5_executive_alerts": lambda m: m.executive_alerts(ordered=True),
    "d5a_high_arrears": lambda m: alerts.high_arrears(m.stg_payroll),
    "d5b_chronic_lateness": lambda m: m.chronic_lateness(),
    "d5c_department_absence": lambda m: m.department_absence(),
    "d5d_excessive_overtime": lambda m: m.excessive_overtime(),
    "d5e_recent_terminations": lambda m: alerts.recent_terminations(m.stg_workforce, m.as_of),
    "d6_executive_kpis": lambda m: m.executive_kpis(),
    "d6a_headcount": lambda m: kpis.headcount(m.stg_workforce, m.as_of),
    "d6b_attendance_30d": lambda m: kpis.attendance_window(m.stg_daily_attendance, m.as_of),
    "d6c_latest_payroll": lambda m: kpis.latest_payroll(m.stg_payroll_main),
    "d6d_payroll_ytd": lambda m: kpis.payroll_ytd(m.stg_payroll_main, m.as_of),
    "d6e_payroll_trend": lambda m: kpis.payroll_trend(m.stg_payroll_main, m.as_of),
    "d7_headcount_metrics": lambda m: m.headcount_metrics(ordered=True),
    "d8_monthly_payroll_metrics": lambda m: m.monthly_payroll_metrics(ordered=True),
    "d9_payroll_period_metrics": lambda m: m.payroll_period_metrics(ordered=True),
    "d10_shift_coverage_metrics": lambda m: m.shift_coverage_metrics(ordered=True),
    "d11_workforce_metrics": lambda m: m.workforce_metrics(ordered=True),
}


def _payroll_of(m: WorkforceModel, period: str) -> DataFrame:
    since, until = reports.month_bounds(period)
    return m.payroll_analytics(since=since, until=until)


REPORT_QUERIES: dict[str, Callable[[WorkforceModel], DataFrame]] = {
    "e1_kpi_row": lambda m: reports.kpi_row(m.executive_kpis()),
    "e2_attendance_trend": lambda m: reports.attendance_trend(
        m.attendance_daily_metrics(), m.as_of),
    "e3_payroll_by_period": lambda m: reports.payroll_by_period(
        m.payroll_period_metrics(since=reports.period_window_start(m.as_of)), m.as_of),
    "e4_top_alerts": lambda m: reports.top_alerts(m.executive_alerts()),
    "e4b_alerts_shown": lambda m: reports.alerts_shown(m.executive_alerts()),
    "e5_basic_counts": lambda m: reports.basic_counts(
        m.stg_payroll, m.raw.crmc_payrollfile, m.stg_attendance, m.raw.activity_log),
    "e6_workforce_summary": lambda m: reports.workforce_summary(m.workforce_demographics()),
    "e7_headcount_by_department": lambda m: reports.headcount_by_department(
        m.workforce_demographics()),
    "e8_tenure_distribution": lambda m: reports.tenure_distribution(m.workforce_demographics()),
    "e9_employee_types": lambda m: reports.employee_types(m.workforce_demographics()),
    "e10_manager_spans": lambda m: reports.manager_spans(m.workforce_demographics()),
    "e11_workforce_departments": lambda m: reports.department_choices(
        m.workforce_demographics()),
    "e12_employee_details": lambda m: reports.employee_details(m.workforce_demographics()),
    "e12_employee_details_filtered": lambda m: reports.employee_details(
        m.workforce_demographics(), department="ICU NATION_0", status="Active",
        tenure_band="10-19 Years"),
    "e13_attendance_summary": lambda m: reports.attendance_summary(
        m.attendance_daily_metrics(), *WINDOW),
    "e14_daily_presence": lambda m: reports.daily_presence(m.attendance_daily_metrics(), *WINDOW),
    "e15_departments_by_attendance": lambda m: reports.departments_by_attendance(
        m.attendance_daily_metrics(), *WINDOW),
    "e16_attendance_departments": lambda m: reports.departments_with_facts(
        m.stg_daily_attendance, m.stg_workforce, workforce_grain=m.workforce_grain),
    "e17_attendance_records": lambda m: reports.attendance_records(
        m.daily_attendance_detail(), *WINDOW),
    "e17_attendance_records_filtered": lambda m: reports.attendance_records(
        m.daily_attendance_detail(), *WINDOW, department="ICU NATION_0", status="Present",
        late_only=True),
    "e18_payroll_ytd_summary": lambda m: reports.payroll_ytd_summary(
        m.payroll_period_metrics(since=m.as_of.replace(month=1, day=1),
                                 until=m.as_of.replace(month=12, day=31)), m.as_of),
    "e19_payroll_trend": lambda m: reports.payroll_trend(
        m.payroll_period_metrics(newest_months=reports.PERIODS)),
    "e20_latest_period_departments": lambda m: reports.latest_period_departments(
        m.payroll_period_metrics(latest_only=True)),
    "e21_top_earners": lambda m: reports.top_earners(
        m.payroll_analytics(latest_only=True)),
    "e22_deductions_and_taxes": lambda m: reports.deductions_and_taxes(
        m.payroll_period_metrics(newest_months=reports.TAX_PERIODS)),
    "e23_period_choices": lambda m: reports.period_choices(m.stg_payroll_main),
    "e24_payroll_departments": lambda m: reports.departments_with_facts(
        m.stg_payroll_main.where(F.col("pay_date").isNotNull()), m.stg_workforce,
        workforce_grain=m.workforce_grain),
    "e25_payroll_records": lambda m: reports.payroll_records(
        m.payroll_analytics(highest=reports.DETAIL_ROWS)),
    "e25_payroll_records_filtered": lambda m: reports.payroll_records(
        _payroll_of(m, YEAR_MONTH), period=YEAR_MONTH, department="ICU NATION_0"),
    "e26_employee_search": lambda m: reports.employee_search(m.employee_summary(), "aDa 1_"),
    "e26_employee_list": lambda m: reports.employee_search(m.employee_summary()),
    "e27_enrolment_by_plan_type": lambda m: reports.enrolment_by_plan_type(
        m.headcount_metrics()),
    "e27_top_plan_types": lambda m: reports.top_plan_types(m.headcount_metrics()),
    "e27_plan_type_choices": lambda m: reports.plan_type_choices(m.headcount_metrics()),
    "e28_benefits_detail": lambda m: reports.benefits_detail(m.payroll_detail()),
    "e28_benefits_detail_filtered": lambda m: reports.benefits_detail(
        m.payroll_detail(), "ECONOMY"),
    "e29_recent_activity": lambda m: reports.recent_activity(m.stg_activity_log),
    "e30_activity_by_module": lambda m: reports.activity_by_module(m.stg_activity_log),
    "g1_longest_tenured": lambda m: reports.longest_tenured(
        m.workforce_demographics(), m.stg_payroll_main),
    "g2_department_payroll": lambda m: reports.department_payroll(m.workforce_metrics()),
    "g3_monthly_payroll": lambda m: reports.monthly_payroll(
        m.payroll_period_metrics(newest_months=reports.PERIODS),
        m.monthly_overtime(reports.PERIODS)),
    "g4_monthly_attendance": lambda m: reports.monthly_attendance(
        m.attendance_daily_metrics(newest_months=reports.TOP_ROWS),
        m.department_headcount(reports.TOP_ROWS)),
    "g5_top_salaries": lambda m: reports.top_salaries(m.workforce_demographics()),
    "g6_salary_by_department": lambda m: reports.salary_by_department(
        m.workforce_demographics()),
    "g6_headcount_from_metrics": lambda m: reports.headcount_from_metrics(m.workforce_metrics()),
    "g7_earnings_per_employee": lambda m: reports.earnings_per_employee(
        m.stg_workforce, m.stg_payroll_main),
    "g8_first_employees": lambda m: reports.first_employees(m.employee_summary()),
}


def _recent_coverage(m: WorkforceModel) -> DataFrame:
    """Coverage of the weeks starting in the last four, from those weeks' punches only."""
    since = _monday_on_or_after(m.as_of - dt.timedelta(weeks=4))
    return m.shift_coverage(since=since)


def _month_coverage(m: WorkforceModel, month: str) -> DataFrame:
    since, until = reports.month_bounds(month)
    return m.shift_coverage(since=since, until=until)


def _recent_ratios(m: WorkforceModel) -> DataFrame:
    since = _monday_on_or_after(m.as_of - dt.timedelta(weeks=4))
    return m.staffing_ratios(since=since)


def _month_ratios(m: WorkforceModel, month: str) -> DataFrame:
    """Weeks starting in the month: from its first Monday to six days past its end."""
    since, until = reports.month_bounds(month)
    return m.staffing_ratios(since=_monday_on_or_after(since),
                             until=until + dt.timedelta(days=6))


HEALTHCARE_QUERIES: dict[str, Callable[[WorkforceModel], DataFrame]] = {
    "h1_clinical_roles": lambda m: m.clinical_staff().groupBy("clinical_role").agg(
        row_count().alias("staff_count")),
    "h2_care_units": lambda m: m.clinical_staff().groupBy("care_unit_type").agg(
        row_count().alias("staff_count")),
    "h3_clinical_staff": lambda m: m.clinical_staff(),
    "h4_shift_types": lambda m: m.shift_punches().groupBy("shift_type").agg(
        row_count().alias("shifts")),
    "h5_day_types": lambda m: m.shift_punches().groupBy("day_type").agg(
        row_count().alias("shifts")),
    "h6_shift_flags": lambda m: m.shift_punches().groupBy(
        "shift_type", "day_type", "is_extended_shift", "has_differential").agg(
        row_count().alias("shifts")),
    "h7_shift_coverage": lambda m: m.shift_coverage(),
    "h7_monthly_coverage": lambda m: hc.monthly_coverage(m.shift_coverage()),
    "h7_high_overtime_weeks": lambda m: hc.high_overtime_weeks(m.shift_coverage()),
    "h8_clinical_workforce": lambda m: hc.clinical_workforce(m.clinical_staff()),
    "h8_burnout_by_department": lambda m: hc.burnout_by_department(
        hc.clinical_workforce(m.clinical_staff())),
    "h8_new_hire_share": lambda m: hc.new_hire_share(hc.clinical_workforce(m.clinical_staff())),
    "h9_staffing_ratios": lambda m: m.staffing_ratios(),
    "h9_icu_compliance": lambda m: hc.icu_compliance(_recent_ratios(m), m.as_of),
    "h9_understaffed_shifts": lambda m: hc.understaffed_shifts(
        m.staffing_ratios(since=_monday_on_or_after(m.as_of.replace(month=1, day=1))), m.as_of),
    "h10_staff_distribution": lambda m: hc.staff_distribution(m.clinical_staff()),
    "h11_burnout_groups": lambda m: hc.burnout_groups(m.clinical_staff()),
    "h11_burnout_groups_from_20_hours": lambda m: hc.burnout_groups(
        m.clinical_staff(), minimum_hours=20.0),
    "h12_coverage_by_week": lambda m: hc.coverage_by_week(_recent_coverage(m), m.as_of),
    "h13_staffing_this_month": lambda m: hc.staffing_this_month(
        _month_ratios(m, THIS_MONTH), AS_OF),
    "h14_critical_care_summary": lambda m: hc.critical_care_summary(
        hc.clinical_workforce(m.clinical_staff())),
    "h15_differential_pay": lambda m: hc.differential_pay(
        _month_coverage(m, THIS_MONTH), THIS_MONTH),
    "h16_turnover_indicators": lambda m: hc.turnover_indicators(
        hc.clinical_workforce(m.clinical_staff())),
    "h17_icu_nurses_at_risk": lambda m: hc.icu_nurses_at_risk(m.clinical_staff()),
    "h17_active_staff_by_role": lambda m: hc.active_staff_by_role(m.clinical_staff()),
    "h18_night_shift_staffing": lambda m: hc.night_shift_staffing(
        m.stg_daily_attendance, m.stg_workforce, m.as_of),
    "h18_weekend_coverage": lambda m: hc.weekend_coverage(
        m.stg_daily_attendance, m.stg_workforce, m.as_of),
    "h19_rn_shortfalls": lambda m: hc.rn_shortfalls(m.staffing_ratios()),
    "h20_differential_hours": lambda m: hc.differential_hours(
        _month_coverage(m, YEAR_MONTH), YEAR_MONTH),
    "h21_retention_risks": lambda m: hc.retention_risks(m.clinical_staff()),
    "h22_variable_shifts": lambda m: hc.variable_shifts(m.staffing_ratios()),
}


# Queries that also run over one master row per employee.
LATEST_TWINS = ("c2_daily_attendance_detail", "c4_payroll_analytics", "d1_attendance_daily_metrics",
                "d5b_chronic_lateness", "d5c_department_absence", "d5d_excessive_overtime",
                "d9_payroll_period_metrics", "e16_attendance_departments", "e24_payroll_departments")


def all_queries() -> dict[str, Query]:
    def over_model(name: str, build: Callable[[WorkforceModel], DataFrame],
                   grain: Grain = "snapshot") -> Query:
        return over_files(name, lambda spark, directory: build(model_of(spark, directory, grain)))

    def over_files(name: str, build: Query) -> Query:
        def query(spark: SparkSession, directory: str) -> DataFrame:
            limit_methods(spark)
            return comparable(build(spark, directory), HOLDS_NULLS.get(name, ()))
        return query

    found = {name: over_files(name, build) for name, build in INGEST.items()}
    groups = VIEW_QUERIES | REPORT_QUERIES | HEALTHCARE_QUERIES
    found.update((name, over_model(name, build)) for name, build in groups.items())
    found.update((f"{name}_latest", over_model(name, groups[name], "latest")) for name in LATEST_TWINS)
    return found
