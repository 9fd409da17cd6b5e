import datetime as dt
from decimal import Decimal

import pytest
from conftest import AS_OF, dicts

from rosterloom.plans import business
from rosterloom.plans.bands import TENURE_BANDS, band_position

DAY = dt.date(2024, 6, 3)


def test_status_texts_and_hours(make):
    statuses = [1, 2, 3, 4, 5, 6, 7, 8, None]
    daily = make.daily([(i, 1, DAY, {"Att_Status_Id": s, "Total_Duration": 50})
                        for i, s in enumerate(statuses)])
    rows = dicts(business.daily_attendance_detail(daily, make.workforce([(1, {})])),
                 "attendance_id")
    assert [r["attendance_status"] for r in rows] == [
        "Present", "Absent", "Leave", "Holiday", "Half Day", "Weekend", "Work From Home",
        "Unknown", "Unknown"]
    assert rows[0]["total_hours"] == 0.83 and rows[0]["day_name"] == "Monday"


def test_detail_repeats_rows_per_snapshot_and_keeps_unmatched(make):
    workforce = make.workforce([
        (1, {"tcpaydt_int_id": 1}), (1, {"tcpaydt_int_id": 2}),
        (1, {"tcpaydt_int_id": 3, "DepartmentName": "ER"}), (2, {}), (None, {})])
    daily = make.daily([(10, 1, DAY, {}), (11, 3, DAY, {}), (12, None, DAY, {})])

    def found(grain):
        rows = dicts(business.daily_attendance_detail(daily, workforce, workforce_grain=grain),
                     "attendance_id", "department_name")
        return [(r["attendance_id"], r["department_name"]) for r in rows]

    assert found("snapshot") == [(10, "ER"), (10, "ICU"), (10, "ICU"), (11, None), (12, None)]
    assert found("latest") == [(10, "ER"), (11, None), (12, None)]
    with pytest.raises(ValueError):
        found("monthly")


def test_employee_summary_counts_and_lists_types(make):
    person = {"Employee ID": "A", "emp_Int_id": "1", "First Name": "Ann", "Last Name": "Lee"}
    rows = dicts(business.employee_summary(make.benefits([
        {**person, "Benefit Plan Type": "Vision", "Benefit Plan Name": "P1",
         "Current Arrears": 1, "Corp_Id": 1},
        {**person, "Benefit Plan Type": "Dental", "Benefit Plan Name": "P1",
         "Current Arrears": 2, "Corp_Id": 2},
        {**person, "Benefit Plan Type": "Dental", "Benefit Plan Name": None},
        {"Employee ID": "B", "Last Name": "Roe"}])), "employee_id")
    assert rows[0]["num_benefit_plans"] == 1
    assert rows[0]["benefit_plan_types"] == "Dental, Vision"
    assert rows[0]["total_current_arrears"] == 3 and rows[0]["total_arrears"] is None
    assert rows[0]["corp_id"] == 2 and rows[0]["full_name"] == "Ann Lee"
    assert rows[1]["num_benefit_plans"] == 0 and rows[1]["benefit_plan_types"] is None
    assert rows[1]["full_name"] is None


def test_payroll_rates(make):
    workforce = make.workforce([(1, {"Emprate": 20}), (2, {"Emprate": None})])
    pay = make.pay([
        (1, 1, DAY, {"gross_pay": 250, "total_hrs": 10, "empr_taxes": 3, "empr_amt": 2}),
        (2, 1, DAY, {"gross_pay": 250}), (3, 2, DAY, {"gross_pay": 250, "total_hrs": 10}),
        (4, 9, DAY, {"gross_pay": 1}), (5, 1, None, {})])
    rows = dicts(business.payroll_analytics(pay, workforce), "payroll_work_id")
    assert [(r["effective_hourly_rate"], r["rate_premium"]) for r in rows] == [
        (25.0, 5.0), (20.0, 0.0), (25.0, 0.0), (None, 0.0)]
    assert rows[0]["total_employer_cost"] == Decimal("255.00")
    assert (rows[0]["pay_period"], rows[0]["pay_quarter"]) == ("2024-06", 2)


def _years_back(years):
    return f"{AS_OF.year - years}-01-15"


def test_tenure_and_age_bands_at_their_edges(make):
    years = [0, 1, 2, 3, 4, 5, 9, 10, 19, 20]
    rows = dicts(business.with_tenure_and_age(
        make.workforce([(i, {"HireDate": _years_back(y)}) for i, y in enumerate(years)]), AS_OF),
        "employee_int_id")
    assert [r["tenure_band"] for r in rows] == [
        "< 1 Year", "1-2 Years", "1-2 Years", "3-4 Years", "3-4 Years", "5-9 Years",
        "5-9 Years", "10-19 Years", "10-19 Years", "20+ Years"]
    assert rows[0]["age_band"] == "Unknown"
    ages = [24, 25, 34, 35, 44, 45, 54, 55, 64, 65]
    rows = dicts(business.with_tenure_and_age(
        make.workforce([(i + 10, {"DOB": _years_back(a)}) for i, a in enumerate(ages)]), AS_OF),
        "employee_int_id")
    assert [r["age_band"] for r in rows] == [
        "Under 25", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55-64", "55-64",
        "65+"]


def test_spans_count_distinct_active_reports_by_name(make):
    staff, key = [], 100
    sizes = {"F 1": 1, "F 2": 5, "F 3": 6, "F 4": 10, "F 5": 11, "F 6": 20, "F 7": 21}
    for manager, size in sizes.items():
        for _ in range(size):
            staff.append((key, {"ReportingManager": manager}))
            staff.append((key, {"ReportingManager": manager, "tcpaydt_int_id": 2}))
            key += 1
        staff.append((key, {"ReportingManager": manager, "EmployeeStatus": "Terminated"}))
        key += 1
    managers = [(i, {}) for i in range(1, 9)] + [(9, {"First Name": None}), (77, {"Last Name": "1"})]
    rows = {r["employee_int_id"]: r for r in dicts(business.workforce_demographics(
        make.workforce(managers + staff), AS_OF))}
    assert [rows[i]["direct_reports"] for i in range(1, 9)] == [1, 5, 6, 10, 11, 20, 21, 0]
    assert [rows[i]["manager_span"].split(" (")[0] for i in range(1, 9)] == [
        "Small Team", "Small Team", "Medium Team", "Medium Team", "Large Team", "Large Team",
        "Very Large Team", "Individual Contributor"]
    assert rows[9]["direct_reports"] == 0 and rows[77]["direct_reports"] == 1


def test_salary_estimate(make):
    rows = dicts(business.workforce_demographics(make.workforce([
        (1, {"Emprate": 10}), (2, {"Emprate": 10, "standrd_wk_hours": 20}), (3, {})]), AS_OF),
        "employee_int_id")
    assert [r["estimated_annual_salary"] for r in rows] == [20800, 10400, 0]


def test_sorted_views(make):
    benefits = make.benefits([
        {"Employee ID": "A", "First Name": f, "Last Name": n} for f, n in
        (("b", "y"), ("a", "y"), ("c", None), ("d", "x"))])
    names = [(r["last_name"], r["first_name"])
             for r in dicts(business.payroll_detail(benefits, ordered=True))]
    assert names == [("x", "d"), ("y", "a"), ("y", "b"), (None, "c")]


def test_staffing_by_shift_sums(make):
    row = {"Emp_ID": "A", "Shift": "Day", "Week Number": 1, "Total Hours": 8, "hours": 7}
    rows = dicts(business.staffing_by_shift(make.weekly([
        {**row, "shiff_diff_yn": True, "RATE": 10}, {**row, "shiff_diff_yn": None, "RATE": 11},
        {**row, "shiff_diff_yn": False}])))
    assert len(rows) == 1
    assert (rows[0]["record_count"], rows[0]["hours"], rows[0]["shift_diff_hours"]) == (3, 21, 7)
    assert rows[0]["avg_rate"] == 10.5


def test_band_positions(spark):
    from pyspark.sql import functions as F
    frame = spark.createDataFrame([("20+ Years",), ("< 1 Year",), ("Unknown",), (None,)], "b string")
    rows = frame.select(band_position(F.col("b"), TENURE_BANDS).alias("p")).collect()
    assert [r.p for r in rows] == [6, 1, 7, 7]
