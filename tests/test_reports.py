import datetime as dt

import pytest
from conftest import AS_OF, dicts

from rosterloom.plans import business, metrics, reports

JUNE = (dt.date(2024, 6, 1), dt.date(2024, 6, 30))


@pytest.mark.parametrize("as_of, expected", [
    (dt.date(2024, 6, 30), dt.date(2023, 12, 1)), (dt.date(2024, 8, 31), dt.date(2024, 2, 1)),
    (dt.date(2024, 1, 1), dt.date(2023, 7, 1))])
def test_period_window_start(as_of, expected):
    assert reports.period_window_start(as_of) == expected


def test_month_bounds():
    assert reports.month_bounds("2024-02") == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert reports.month_bounds("2023-12") == (dt.date(2023, 12, 1), dt.date(2023, 12, 31))


@pytest.fixture
def demographics(make):
    return business.workforce_demographics(make.workforce([
        (1, {"DepartmentName": "ICU", "HireDate": "2010-01-01"}),
        (2, {"DepartmentName": "ER", "HireDate": "2024-01-01"}),
        (3, {"DepartmentName": None, "EmployeeStatus": "Terminated"}),
        (4, {"DepartmentName": "ER", "HireDate": "2024-02-01"})]), AS_OF)


def test_details_fold_only_the_given_filters(demographics):
    assert reports.employee_details(demographics).count() == 4
    assert reports.employee_details(demographics, department="ER").count() == 2
    assert reports.employee_details(demographics, department="ER", status="Active",
                                    tenure_band="< 1 Year").count() == 2
    assert reports.employee_details(demographics, status="Terminated",
                                    department="ER").count() == 0


def test_details_put_nulls_last(demographics):
    names = [r["department_name"] for r in dicts(reports.employee_details(demographics))]
    assert names == ["ER", "ER", "ICU", None]


def test_distributions(demographics):
    assert [(r["tenure_band"], r["count"]) for r in
            dicts(reports.tenure_distribution(demographics))] == [
        ("< 1 Year", 2), ("10-19 Years", 1)]
    top = dicts(reports.headcount_by_department(demographics, k=1))
    assert top == [{"department_name": "ER", "count": 2}]
    assert [r["department_name"] for r in dicts(reports.department_choices(demographics))] == [
        "ER", "ICU"]


def test_attendance_reports_over_the_daily_metrics(make):
    day = dt.date(2024, 6, 3)
    daily = make.daily([(1, 1, day, {}), (2, 2, day, {"Att_Status_Id": 2, "OT_Duration": 30}),
                        (3, 1, dt.date(2024, 5, 31), {}), (None, 1, dt.date(2024, 6, 4), {})])
    view = metrics.attendance_daily_metrics(daily, make.workforce([(1, {}), (2, {})]))
    summary = dicts(reports.attendance_summary(view, *JUNE))[0]
    assert (summary["total_records"], summary["present"], summary["attendance_rate"]) == (2, 1, 50.0)
    assert summary["ot_hours"] == 0.5
    trend = dicts(reports.attendance_trend(view, AS_OF))
    assert [(r["attendance_date"], r["rate"]) for r in trend] == [
        (dt.date(2024, 5, 31), 100.0), (day, 50.0), (dt.date(2024, 6, 4), None)]


def test_record_filters(make):
    day = dt.date(2024, 6, 3)
    daily = make.daily([(1, 1, day, {"Late_By_Mins": 2}), (2, 1, day, {})])
    detail = business.daily_attendance_detail(daily, make.workforce([(1, {})]))
    assert reports.attendance_records(detail, *JUNE).count() == 2
    assert reports.attendance_records(detail, *JUNE, late_only=True).count() == 1
    assert reports.attendance_records(detail, *JUNE, status="Absent").count() == 0


def test_last_periods_come_oldest_first(spark):
    view = spark.createDataFrame(
        [(f"2024-{m:02d}", m * 1.0, 0.0) for m in range(1, 9)],
        "pay_period string, total_gross_pay double, total_employer_cost double")
    assert [r["pay_period"] for r in dicts(reports.payroll_trend(view, k=3))] == [
        "2024-06", "2024-07", "2024-08"]


def test_search_ignores_case_in_names_only(make):
    people = business.employee_summary(make.benefits([
        {"Employee ID": "E1x", "First Name": "Ann", "Last Name": "Lee"},
        {"Employee ID": "e2", "First Name": "Bob", "Last Name": "Roe"},
        {"Employee ID": "E3", "First Name": None, "Last Name": "Lee"}]))

    def found(text):
        return sorted(r["employee_id"] for r in dicts(reports.employee_search(people, text)))

    assert found("LEE") == ["E1x"] and found("e1x") == [] and found("E1x") == ["E1x"]
    assert found("_nn") == ["E1x"] and found("") == ["E1x", "E3", "e2"]


def test_activity_counts_only_the_newest(spark):
    rows = [(str(i), dt.datetime(2024, 1, 1, 0, i % 60, i // 60), None if i % 10 == 0 else "m",
             "t", "u", "ip") for i in range(150)]
    frame = spark.createDataFrame(rows, "activity_id string, activity_timestamp timestamp, "
                                        "module string, activity_type string, "
                                        "entered_by string, system_ip string")
    newest = reports.recent_activity(frame)
    assert newest.count() == 100
    counted = dicts(reports.activity_by_module(frame))
    assert counted == [{"module": "m",
                        "count": sum(r["module"] is not None for r in dicts(newest))}]


def test_earnings_keep_every_master_row(make):
    staff = make.workforce([(1, {}), (1, {"tcpaydt_int_id": 2}), (2, {})])
    pay = make.pay([(1, 1, AS_OF, {"gross_pay": 5}), (2, 1, AS_OF, {"gross_pay": 6})])
    rows = dicts(reports.earnings_per_employee(staff, pay), "employee_int_id")
    assert [r["total_earnings"] for r in rows] == [11, 11, None]


def test_departments_with_facts_are_those_of_the_detail_view(make):
    staff = make.workforce([(1, {"DepartmentName": "ICU", "tcpaydt_int_id": 1}),
                            (1, {"DepartmentName": "ER", "tcpaydt_int_id": 2}),
                            (2, {"DepartmentName": "OR"}), (3, {"DepartmentName": None})])
    daily = make.daily([(1, 1, AS_OF, {}), (2, 3, AS_OF, {}), (3, None, AS_OF, {})])
    for grain, expected in (("snapshot", ["ER", "ICU"]), ("latest", ["ER"])):
        view = business.daily_attendance_detail(daily, staff, workforce_grain=grain)
        ours = dicts(reports.departments_with_facts(daily, staff, grain))
        assert ours == dicts(reports.department_choices(view))
        assert [r["department_name"] for r in ours] == expected


def test_period_choices_are_distinct_months(make):
    pay = make.pay([(i, 1, day, {}) for i, day in enumerate(
        [dt.date(2024, 1, 5), dt.date(2024, 1, 9), dt.date(2024, 3, 1), None])])
    assert [r["pay_period"] for r in dicts(reports.period_choices(pay))] == ["2024-03", "2024-01"]
