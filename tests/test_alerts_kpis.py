import datetime as dt
from decimal import Decimal

from conftest import AS_OF, LOADED_AT, dicts

from rosterloom.plans import alerts, kpis, reports


def day(back):
    return AS_OF - dt.timedelta(days=back)


def test_arrears_past_the_limit_one_alert_per_line(make):
    line = {"Employee ID": "A", "First Name": "Ann", "Last Name": "Lee"}
    rows = dicts(alerts.high_arrears(make.benefits([
        {**line, "Current Arrears": 500}, {**line, "Current Arrears": "500.01"},
        {**line, "Current Arrears": "500.01"}, line])))
    assert [r["metric_value"] for r in rows] == ["500.01", "500.01"]
    assert rows[0]["detail"] == "Amount: $500.01" and rows[0]["employee_name"] == "Ann Lee"


def _attendance(make):
    late, ot = {"Late_By_Mins": 3}, {"OT_Duration": 600}
    return make.daily(
        [(i, 1, day(i), late) for i in range(5)] + [(i, 2, day(i), late) for i in range(6)]
        + [(i, 3, day(30), late) for i in range(6)] + [(i, 4, day(31), late) for i in range(9)]
        + [(50 + i, 5, day(1), ot) for i in range(2)]
        + [(60 + i, 6, day(1), {"OT_Duration": 601}) for i in range(2)]
        + [(70 + i, 7, day(1), {"Att_Status_Id": 2 if i < 2 else 1}) for i in range(10)]
        + [(80 + i, 8, day(1), {"Att_Status_Id": 2 if i < 1 else 1}) for i in range(10)])


def _staff(make):
    departments = {7: "ER", 8: "OR"}
    return make.workforce([(i, {"DepartmentName": departments.get(i, "ICU")})
                           for i in range(1, 9)])


def test_attendance_rules_at_their_limits(make):
    daily, staff = _attendance(make), _staff(make)
    late = dicts(alerts.chronic_lateness(daily, staff, AS_OF), "employee_id")
    assert [(r["employee_id"], r["detail"]) for r in late] == [
        ("2", "Late 6 times in 30 days"), ("3", "Late 6 times in 30 days")]
    overtime = dicts(alerts.excessive_overtime(daily, staff, AS_OF))
    assert [(r["employee_id"], r["metric_value"]) for r in overtime] == [("6", "20.0")]
    absence = dicts(alerts.department_absence(daily, staff, AS_OF))
    assert [(r["employee_id"], r["detail"]) for r in absence] == [("ER", "20.0% absence rate")]


def test_snapshots_multiply_late_rows(make):
    daily = make.daily([(i, 1, day(1), {"Late_By_Mins": 1}) for i in range(3)])
    staff = make.workforce([(1, {"tcpaydt_int_id": 1}), (1, {"tcpaydt_int_id": 2})])
    assert dicts(alerts.chronic_lateness(daily, staff, AS_OF))[0]["metric_value"] == "6"
    assert alerts.chronic_lateness(daily, staff, AS_OF, workforce_grain="latest").count() == 0


def test_terminations_of_the_last_week(make):
    rows = dicts(alerts.recent_terminations(make.workforce([
        (i, {"EmployeeStatus": status, "StatusDate": str(day(back))})
        for i, (status, back) in enumerate([("Terminated", 7), ("Terminated", 8),
                                            ("Active", 1)])]), AS_OF))
    assert [r["employee_id"] for r in rows] == ["E0"]
    assert rows[0]["detail"] == f"Terminated on {day(7)}"


def test_all_alerts_are_the_union_of_the_rules_in_order(make):
    daily, staff = _attendance(make), _staff(make)
    benefits = make.benefits([{"Employee ID": "A", "Current Arrears": 900}])
    ordered = dicts(alerts.executive_alerts(benefits, daily, staff, AS_OF,
                                            detected_at=LOADED_AT, ordered=True))
    assert [(r["priority"], r["alert_type"]) for r in ordered] == [
        ("High", "HIGH_ARREARS"), ("Medium", "CHRONIC_LATENESS"), ("Medium", "CHRONIC_LATENESS"),
        ("Medium", "DEPT_HIGH_ABSENCE"), ("Low", "EXCESSIVE_OT")]
    parts = (alerts.high_arrears(benefits).unionByName(
        alerts.chronic_lateness(daily, staff, AS_OF)).unionByName(
        alerts.department_absence(daily, staff, AS_OF)).unionByName(
        alerts.excessive_overtime(daily, staff, AS_OF)))
    together = alerts.executive_alerts(benefits, daily, staff, AS_OF).drop("detected_at")
    assert together.exceptAll(parts).count() == 0 == parts.exceptAll(together).count()


def test_alerts_shown_keep_five_per_lower_priority(spark):
    rows = ([("HIGH_ARREARS", "High", f"h{i}", f"H{i}", "", "", f"d{i}") for i in range(7)]
            + [("CHRONIC_LATENESS", "Medium", f"m{i}", f"M{i}", "", "", "d") for i in range(6)]
            + [("EXCESSIVE_OT", "Low", f"l{i}", f"L{i}", "", "", "d") for i in range(9)])
    frame = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in alerts.COLUMNS))
    assert reports.top_alerts(frame).count() == 20
    shown = dicts(reports.alerts_shown(frame), "priority", "employee_name")
    counts = [sum(r["priority"] == p for r in shown) for p in alerts.PRIORITIES]
    assert counts == [7, 5, 5]


def _kpi_inputs(make):
    staff = make.workforce([
        (1, {"HireDate": str(day(30))}), (1, {"tcpaydt_int_id": 2}),
        (2, {"EmployeeStatus": "Terminated", "HireDate": str(day(31))}),
        (3, {"DepartmentName": None})])
    daily = make.daily([(1, 1, day(1), {"OT_Duration": 90}), (2, 1, day(2), {"Att_Status_Id": 5}),
                        (3, 2, day(31), {})])
    return staff, daily


def test_kpis(make):
    staff, daily = _kpi_inputs(make)
    pay = make.pay([
        (1, 1, dt.date(2024, 6, 28), {"gross_pay": 100, "net_pay": 70, "total_hrs": 8,
                                      "empr_taxes": 5, "empr_amt": 1}),
        (2, 2, dt.date(2024, 1, 1), {"gross_pay": 50}),
        (3, 2, dt.date(2023, 12, 31), {"gross_pay": 25}), (4, 2, None, {"gross_pay": 1})])
    rows = dicts(kpis.executive_kpis(staff, daily, pay, AS_OF))
    assert len(rows) == 1
    row = rows[0]
    assert (row["total_employees"], row["active_employees"], row["terminated_employees"],
            row["new_hires_30d"], row["total_departments"]) == (3, 2, 1, 1, 1)
    assert (row["attendance_records_30d"], row["present_days"], row["absent_days"],
            row["attendance_rate_30d"], row["total_ot_hours_30d"]) == (2, 1, 1, 50.0, 1.5)
    assert row["latest_pay_date"] == dt.date(2024, 6, 28)
    assert (row["latest_gross_payroll"], row["latest_employer_cost"]) == (100, 6)
    assert row["ytd_gross_payroll"] == Decimal("150.00")
    assert (row["avg_gross_pay_per_employee"], row["avg_hours_per_employee"]) == (50.0, 8.0)


def test_no_pay_rows_no_kpi_row(make):
    staff, daily = _kpi_inputs(make)
    assert kpis.executive_kpis(staff, daily, make.pay([]), AS_OF).count() == 0
    assert reports.kpi_row(kpis.executive_kpis(staff, daily, make.pay([]), AS_OF)).count() == 0


def test_trend_takes_the_newest_month_in_range(make):
    pay = make.pay([(1, 1, dt.date(2024, 4, 1), {"gross_pay": 5}),
                    (2, 1, dt.date(2024, 4, 9), {"gross_pay": 6}),
                    (3, 1, dt.date(2023, 12, 1), {"gross_pay": 7})])
    assert dicts(kpis.payroll_trend(pay, AS_OF)) == [
        {"pay_period": "2024-04", "period_gross_pay": Decimal("11.00")}]
    old = make.pay([(3, 1, dt.date(2023, 12, 29), {})])
    assert kpis.payroll_trend(old, AS_OF).count() == 0
