import datetime as dt

from conftest import AS_OF, dicts
from pyspark.sql import functions as F

from rosterloom.plans import healthcare as hc

MONDAY = dt.date(2024, 6, 3)
SATURDAY = dt.date(2024, 6, 8)


def at(hour, day=MONDAY, minute=0):
    return dt.datetime.combine(day, dt.time(hour, minute))


def test_shift_types_by_the_hour(make):
    hours = [5, 6, 13, 14, 21, 22, 0]
    rows = dicts(hc.shift_punches(make.daily(
        [(i, i, MONDAY, {"Actual_In_Time": at(h)}) for i, h in enumerate(hours)]
        + [(90, 90, MONDAY, {"In_Time": at(8)}), (91, 91, MONDAY, {})])), "employee_int_id")
    assert [r["shift_type"] for r in rows] == [
        hc.NIGHT, hc.DAY, hc.DAY, hc.EVENING, hc.EVENING, hc.NIGHT, hc.NIGHT, hc.DAY, "Unknown"]


def test_extended_and_differential_flags(make):
    rows = dicts(hc.shift_punches(make.daily([
        (1, 1, MONDAY, {"In_Time": at(8), "Total_Duration": 720}),
        (2, 2, MONDAY, {"In_Time": at(15), "Total_Duration": 721}),
        (3, 3, SATURDAY, {"In_Time": at(8, SATURDAY)})])), "employee_int_id")
    assert [(r["is_extended_shift"], r["has_differential"]) for r in rows] == [
        (False, False), (True, True), (False, True)]


def test_roles_and_units(spark):
    titles = {"RN Charge": hc.RN, "Registered Nurse": hc.RN, "LPN": hc.LPN, "CNA II": hc.CNA,
              "Nurse Practitioner": "Advanced Practice Provider", "Physician": "Physician",
              "Lab Technician": "Technician", "Clerk": "Other", "Burn Unit Clerk": "Other"}
    frame = spark.createDataFrame([(t,) for t in titles], "t string")
    found = dict(frame.select("t", hc.classify(F.col("t"), hc.ROLE_RULES, "Other")).collect())
    assert found == titles
    units = {"ICU North": hc.ICU, "ER": hc.ER, "Surgery": hc.SURGERY, "Pharmacy": "General Care"}
    frame = spark.createDataFrame([(t,) for t in units], "t string")
    assert dict(frame.select(
        "t", hc.classify(F.col("t"), hc.UNIT_RULES, "General Care")).collect()) == units


def test_staff_take_the_newest_snapshot_and_risk_levels(make):
    staff = make.workforce([
        (1, {"JobCodeName": "Clerk", "tcpaydt_int_id": 1}),
        (1, {"JobCodeName": "RN", "tcpaydt_int_id": 2}), (2, {}), (3, {})])
    daily = make.daily([
        (1, 1, MONDAY, {"OT_Duration": 2400, "Total_Duration": 4800}),
        (2, 2, MONDAY, {"OT_Duration": 1200}), (3, 2, MONDAY, {"Att_Status_Id": 2}),
        (4, 3, dt.date(2023, 12, 31), {"OT_Duration": 9000})])
    rows = dicts(hc.clinical_staff(staff, daily, AS_OF), "employee_int_id")
    assert [r["burnout_risk_level"] for r in rows] == [hc.HIGH, hc.MODERATE, hc.LOW]
    assert rows[0]["clinical_role"] == hc.RN and rows[0]["overtime_percentage"] == 50.0
    assert [r["attendance_rate_pct"] for r in rows] == [100.0, 50.0, None]


def test_coverage_counts_heads_not_punches(make):
    staff = make.workforce([(1, {}), (2, {"DepartmentName": "ER"})])
    daily = make.daily([(i, 1, MONDAY, {"In_Time": at(8), "Total_Duration": 600})
                        for i in range(30)] + [(90, None, MONDAY, {"In_Time": at(8)})])
    rows = dicts(hc.shift_coverage(daily, staff), "department")
    assert [(r["department"], r["staff_count"], r["shift_count"]) for r in rows] == [
        ("ICU", 1, 30), (None, 0, 1)]
    assert rows[0]["total_hours_worked"] == 300.0 and rows[0]["avg_hours_per_shift"] == 10.0
    assert rows[1]["overtime_pct"] is None


def test_staffing_ratios_over_days(make):
    staff = make.workforce([(i, {"JobCodeName": "RN" if i < 3 else "Clerk"}) for i in range(1, 5)])
    tuesday = MONDAY + dt.timedelta(days=1)
    daily = make.daily([(i, i, MONDAY, {"In_Time": at(8)}) for i in range(1, 5)]
                       + [(9, 1, tuesday, {"In_Time": at(8, tuesday)}),
                          (10, 1, tuesday, {"In_Time": at(9, tuesday)})])
    row = dicts(hc.staffing_ratios(daily, staff))[0]
    assert (row["days"], row["avg_total_staff_count"], row["min_total_staff_count"],
            row["max_total_staff_count"]) == (2, 2.5, 1, 4)
    assert (row["avg_rn_count"], row["min_rn_count"], row["days_below_min_rn_icu"]) == (1.5, 1, 1)
    assert row["understaffed_days_pct"] == 50.0 and row["staff_count_stddev"] == 2.12
    assert row["week_start_date"] == MONDAY


def test_reports_filter_as_documented(make):
    staff = make.workforce([(1, {"JobCodeName": "RN"}), (2, {"JobCodeName": "RN"}), (3, {})])
    daily = make.daily([(1, 1, MONDAY, {"OT_Duration": 2400}), (2, 3, MONDAY, {"Att_Status_Id": 2}),
                        (3, 2, MONDAY, {})])
    people = hc.clinical_staff(staff, daily, AS_OF)
    assert [r["full_name"] for r in dicts(hc.icu_nurses_at_risk(people))] == ["F 1"]
    assert [r["employee_int_id"] for r in dicts(hc.retention_risks(people))] == [1, 3]
    groups = hc.clinical_workforce(people)
    assert sum(r["staff_count"] for r in dicts(groups)) == 3
