import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

from conftest import AS_OF, dicts

from rosterloom.plans import business, metrics

DAY = dt.date(2024, 6, 3)


def test_daily_metrics_null_keys_and_zero_denominators(make):
    daily = make.daily([
        (1, 1, DAY, {"Late_By_Mins": 10, "Total_Duration": 480}), (1, 1, DAY, {}),
        (2, 1, DAY, {"Att_Status_Id": 2}), (None, 1, DAY, {"Total_Duration": 60}),
        (5, 8, DAY, {"Att_Status_Id": 3}), (None, None, DAY, {"Late_By_Mins": 7})])
    rows = dicts(metrics.attendance_daily_metrics(daily, make.workforce([(1, {})])),
                 "department_name")
    icu, nowhere = rows
    assert (icu["total_records"], icu["unique_employees"], icu["present_count"],
            icu["absent_count"], icu["late_count"]) == (2, 1, 1, 1, 1)
    assert (icu["presence_rate"], icu["late_rate"], icu["total_hours"]) == (50.0, 50.0, 9.0)
    assert icu["avg_hours_per_employee"] == 9.0 and icu["avg_late_minutes"] == 10.0
    assert (nowhere["total_records"], nowhere["unique_employees"]) == (1, 1)
    assert (nowhere["total_late_minutes"], nowhere["late_count"]) == (7, 0)
    assert nowhere["avg_late_minutes"] == 0.0
    only_null = make.daily([(None, None, DAY, {"Total_Duration": 60})])
    row = dicts(metrics.attendance_daily_metrics(only_null, make.workforce([])))[0]
    assert (row["total_records"], row["presence_rate"], row["avg_hours_per_employee"]) == (0, 0, 0)
    assert row["total_hours"] == 1.0


def _plain_daily(daily, workforce):
    """The daily metrics by hand: the full fan-out, then sets and sums."""
    by_employee = defaultdict(list)
    for person in workforce:
        if person["employee_int_id"] is not None:
            by_employee[person["employee_int_id"]].append(person)
    groups = defaultdict(list)
    for row in daily:
        for person in by_employee.get(row["employee_int_id"]) or [
                {"department_name": None, "department_number": None}]:
            groups[row["attendance_date"], person["department_name"],
                   person["department_number"]].append(row)
    found = {}
    for key, rows in groups.items():
        def ids(keep, column="attendance_id"):
            return len({r[column] for r in rows if keep(r) and r[column] is not None})
        found[key] = (ids(lambda r: True), ids(lambda r: True, "employee_int_id"),
                      ids(lambda r: r["attendance_status_id"] == 1), ids(lambda r: r["is_late"]),
                      sum(r["late_by_mins"] for r in rows),
                      round(sum(r["total_duration"] for r in rows) / 60 + 1e-9, 2))
    return found


def test_daily_metrics_equal_the_plain_join_with_a_hot_employee(make):
    random.seed(3)
    staff = [(random.choice([1, 1, 1, 2, 3, 4, None]),
              {"DepartmentName": random.choice(["ICU", "ER", None]),
               "DepartmentNumber": random.choice(["A", "B"]), "tcpaydt_int_id": i})
             for i in range(60)]
    punches = [(random.choice([None, *range(25)]), random.choice([1, 1, 2, 3, 4, 5, None]),
                DAY + dt.timedelta(days=random.randrange(3)),
                {"Att_Status_Id": random.choice([1, 2, None]),
                 "Late_By_Mins": random.choice([None, 0, 5]), "Total_Duration": 15})
               for _ in range(200)]
    daily, workforce = make.daily(punches), make.workforce(staff)
    ours = {(r["attendance_date"], r["department_name"], r["department_number"]):
            (r["total_records"], r["unique_employees"], r["present_count"], r["late_count"],
             r["total_late_minutes"], r["total_hours"])
            for r in dicts(metrics.attendance_daily_metrics(daily, workforce))}
    assert ours == _plain_daily(dicts(daily), dicts(workforce))


def test_grains_agree_when_the_master_has_one_row_per_employee(make):
    workforce = make.workforce([(1, {}), (2, {"DepartmentName": "ER"})])
    daily = make.daily([(i, i % 3, DAY, {"OT_Duration": i}) for i in range(20)])
    pay = make.pay([(i, i % 3, DAY, {"gross_pay": i}) for i in range(20)])
    for view, facts in ((metrics.attendance_daily_metrics, daily),
                        (metrics.payroll_period_metrics, pay)):
        snapshot = view(facts, workforce, workforce_grain="snapshot", calculated_at=AS_OF)
        latest = view(facts, workforce, workforce_grain="latest", calculated_at=AS_OF)
        assert snapshot.exceptAll(latest).count() == 0 == latest.exceptAll(snapshot).count()


def test_period_metrics_weigh_by_snapshots(make):
    workforce = make.workforce([(1, {"tcpaydt_int_id": 1}), (1, {"tcpaydt_int_id": 2}), (2, {})])
    pay = make.pay([
        (1, 1, DAY, {"gross_pay": 100, "total_hrs": 10, "check_amt": 5}),
        (2, 2, DAY, {"gross_pay": 40, "ddeposit_amt": 5}), (3, 2, dt.date(2024, 5, 31), {})])
    rows = dicts(metrics.payroll_period_metrics(pay, workforce, ordered=True))
    assert [r["pay_period"] for r in rows] == ["2024-06", "2024-05"]
    june, may = rows
    assert june["total_gross_pay"] == Decimal("240.00") and june["avg_gross_pay"] == 80.0
    assert (june["payroll_records"], june["employees_paid"]) == (2, 2)
    assert (june["check_payments"], june["dd_payments"], june["dd_adoption_rate"]) == (1, 1, 50.0)
    assert (june["min_gross_pay"], june["max_gross_pay"]) == (40, 100)
    assert june["effective_hourly_rate"] == 12.0
    assert may["effective_hourly_rate"] == 0.0 and may["dd_adoption_rate"] == 0.0


def test_workforce_metrics_bands_repeat_per_number(make):
    rows = dicts(metrics.workforce_metrics(make.workforce([
        (1, {"DepartmentNumber": "A", "HireDate": "2024-06-10", "Gender": "F"}),
        (1, {"DepartmentNumber": "A", "HireDate": "2024-06-10", "tcpaydt_int_id": 2}),
        (2, {"DepartmentNumber": "B", "HireDate": "2010-01-01", "EmployeeStatus": "Terminated"}),
        (3, {"DepartmentName": None})]), AS_OF), "department_number")
    assert [r["total_employees"] for r in rows] == [1, 1]
    assert [r["active_employees"] for r in rows] == [1, 0]
    assert [r["new_hires_30d"] for r in rows] == [1, 0]
    assert [(r["tenure_under_1yr"], r["tenure_10_19yr"], r["age_65plus"]) for r in rows] == [
        (1, 1, 0), (1, 1, 0)]
    assert [r["female_count"] for r in rows] == [1, 0]
    assert rows[0]["avg_tenure_years"] == 0.0


def test_shift_coverage_percentage_is_null_without_hours(make):
    row = {"Emp_ID": "A", "Shift": "Day", "Week Number": 1, "RATE": 10}
    staffing = business.staffing_by_shift(make.weekly([
        {**row, "hours": 0, "Total Hours": 0}, {**row, "Week Number": 2, "hours": 4,
                                                "shiff_diff_yn": True}]))
    rows = dicts(metrics.shift_coverage_metrics(staffing), "week_number")
    assert [r["shift_diff_pct"] for r in rows] == [None, 100.0]


def test_enrolment_totals_add_up(make):
    benefits = make.benefits([
        {"Employee ID": e, "Benefit Plan Type": t, "Corp_Id": c, "Current Arrears": 10,
         "Age": 30 + c, "arrears_assigned_yn": flag}
        for e, t, c, flag in (("A", "x", 1, True), ("A", "x", 1, None), ("B", "x", 1, False),
                              ("C", "y", 2, True))])
    rows = dicts(metrics.headcount_metrics(benefits, ordered=True))
    assert [(r["corp_id"], r["employee_count"], r["enrollment_records"]) for r in rows] == [
        (1, 2, 3), (2, 1, 1)]
    assert rows[0]["avg_age"] == 31.0
    plans = dicts(metrics.monthly_payroll_metrics(benefits), "corp_id")
    assert [r["arrears_assigned_count"] for r in plans] == [1, 1]
    assert sum(r["enrollment_records"] for r in plans) == benefits.count()


def test_views_of_nothing_are_empty(make):
    workforce = make.workforce([])
    assert metrics.attendance_daily_metrics(make.daily([]), workforce).count() == 0
    assert metrics.payroll_period_metrics(make.pay([]), workforce).count() == 0
    assert metrics.workforce_metrics(workforce, AS_OF).count() == 0
