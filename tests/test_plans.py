"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import SMALL

from rosterloom.registry import HEALTHCARE_QUERIES, INGEST, REPORT_QUERIES, VIEW_QUERIES, model_of

ALL = {**VIEW_QUERIES, **REPORT_QUERIES, **HEALTHCARE_QUERIES}


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def model(spark):
    return model_of(spark, SMALL)


@pytest.mark.parametrize("name", sorted(ALL))
def test_no_python_no_cartesian_no_single_partition_window(model, name):
    text = plan(ALL[name](model))
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


def test_date_windows_reach_the_files(model):
    for name in ("d5b_chronic_lateness", "d6b_attendance_30d", "e2_attendance_trend",
                 "e14_daily_presence", "h18_night_shift_staffing", "h12_coverage_by_week"):
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate",
                         plan(ALL[name](model))), name
    for name in ("d6d_payroll_ytd", "e3_payroll_by_period", "e18_payroll_ytd_summary",
                 "e25_payroll_records_filtered"):
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate",
                         plan(ALL[name](model))), name


def test_newest_months_cut_before_the_joins(model):
    """A range against a one-row subquery, on the raw date."""
    for name, day in (("e19_payroll_trend", "o_orderdate"), ("e22_deductions_and_taxes", "o_orderdate"),
                      ("g3_monthly_payroll", "o_orderdate"), ("g4_monthly_attendance", "l_shipdate")):
        assert re.search(rf"cast\({day}#\d+ as date\) >= Subquery", plan(ALL[name](model))), name


def test_nothing_is_repartitioned_by_hand(model):
    for name in ALL:
        assert "REPARTITION_BY_NUM" not in plan(ALL[name](model)), name


def test_copies_are_one_generate(model):
    for name in ("c2_daily_attendance_detail", "c4_payroll_analytics"):
        assert plan(ALL[name](model)).count("Generate explode(sequence(") == 1, name


def read_columns(text: str, column: str) -> set[str]:
    """Columns read by the scan holding ``column``."""
    return next(set(re.findall(r"(\w+)#", scan)) for scan in
                re.findall(r"FileScan parquet \[([^\]]*)\]", text) if column in scan)


def test_scans_read_only_what_is_used(model):
    assert read_columns(plan(ALL["e7_headcount_by_department"](model)), "c_custkey") == {
        "c_custkey", "c_nationkey"}
    assert "o_totalprice" not in plan(ALL["d1_attendance_daily_metrics"](model))
    lines = read_columns(plan(ALL["d5a_high_arrears"](model)), "l_extendedprice")
    assert "l_shipdate" not in lines and "l_quantity" not in lines


def test_distinct_counts_are_words_not_expanded_rows(model):
    """One generated copy of a row per further id, whatever number of counts; OR in a hash aggregate."""
    for name, generators in (("d1_attendance_daily_metrics", 1), ("d9_payroll_period_metrics", 1), ("d11_workforce_metrics", 0)):
        text = plan(VIEW_QUERIES[name](model))
        assert text.count("Generate inline") == generators, name
        assert "bit_or" in text and "SortAggregate" not in text and "Expand" not in text, name


def test_newest_snapshots_are_found_without_sorting_all(model):
    for name in ("h3_clinical_staff", "h7_shift_coverage", "h8_clinical_workforce", "h9_staffing_ratios"):
        text = plan(HEALTHCARE_QUERIES[name](model))
        assert "SortAggregate" not in text and "WindowGroupLimit" in text, name


def test_workforce_metrics_read_the_master_once_and_join_nothing_after(model):
    text = plan(VIEW_QUERIES["d11_workforce_metrics"](model))
    own = plan(model.stg_workforce)
    assert text.count("Scan parquet") == own.count("Scan parquet")
    assert len(re.findall("Join", text)) == len(re.findall("Join", own))


def test_quality_report_scans_each_table_once(spark, model):
    """Attendance, its raw table and the master; the master's own view reads several files."""
    own = sum(plan(frame).count("Scan parquet") for frame in (model.stg_daily_attendance, model.raw.thr_attendance, model.stg_workforce))
    assert plan(INGEST["a8_quality_report"](spark, SMALL)).count("Scan parquet") <= own


def test_attendance_rules_share_one_scan(model):
    text = plan(ALL["d5_executive_alerts"](model))
    assert text.count("l_returnflag") and len(re.findall(
        r"FileScan parquet \[[^\]]*l_returnflag", text)) == 1


def test_top_k_needs_no_global_sort(model):
    for name in ("e4_top_alerts", "e12_employee_details", "e25_payroll_records",
                 "e29_recent_activity"):
        text = plan(ALL[name](model))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text, name


def test_composed_views_do_not_sort(model):
    assert "rangepartitioning" not in plan(model.shift_coverage_metrics())
    assert "rangepartitioning" in plan(model.shift_coverage_metrics(ordered=True))


def test_benefit_lines_are_dealt_before_they_are_summed(model):
    """Sums per person and plan of a whole file split would hold nearly all of its lines."""
    text = plan(model.employee_summary())
    assert text.count("REPARTITION_BY_COL") == 1
    assert "Aggregate" not in text[text.index("REPARTITION_BY_COL"):]
