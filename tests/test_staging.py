import datetime as dt
from decimal import Decimal

from conftest import LOADED_AT, dicts, raw_frame

from rosterloom.plans import staging

DAY = dt.date(2024, 6, 3)


def test_activity_log_casts_and_drops_null_ids(make):
    raw = make.raw("activity_log", [
        {"Activity_Id": 1, "Emp_Int_ID": 7, "EnteredDate": dt.datetime(2024, 1, 1), "Corp_ID": 3},
        {"Activity_Id": None, "Emp_Int_ID": 8}])
    rows = dicts(staging.stg_activity_log(raw, LOADED_AT))
    assert len(rows) == 1
    assert rows[0]["activity_id"] == "1" and rows[0]["employee_id"] == "7"
    assert rows[0]["source_table"] == "activity_log" and rows[0]["_loaded_at"] == LOADED_AT


def test_weekly_tables_are_stacked_with_their_names(spark):
    row = {"Emp_ID": "A", "First Name": " Ann ", "Shift": " Day ", "Total Hours": 8}
    frames = {name: raw_frame(spark, name, [row, {"Emp_ID": None}])
              for name in ("attendance_031820", "attendance_031920")}
    rows = dicts(staging.stg_attendance(frames, LOADED_AT), "source_table")
    assert [r["source_table"] for r in rows] == ["attendance_031820", "attendance_031920"]
    assert rows[0]["first_name"] == "Ann" and rows[0]["shift"] == "Day"
    assert rows[0]["total_hours"] == Decimal("8.00")


def test_weekly_numbers_delivered_as_decimals_are_rounded(spark):
    frame = raw_frame(spark, "attendance_031820", [{"Emp_ID": "A"}]).withColumn(
        "Week Number", staging.F.lit(Decimal("2.5")))
    assert dicts(staging.stg_attendance({"t": frame}, LOADED_AT))[0]["week_number"] == 3


def test_daily_defaults_and_flags(make):
    frame = make.daily([
        (1, 10, DAY, {}), (2, 10, DAY, {"Late_By_Mins": 5, "OT_Duration": 30}),
        (3, 10, DAY, {"Early_Left_By_Mins": 1, "Absent_Minutes": 10}),
        (4, 10, DAY, {"Att_Status_Id": 2}), (5, 10, DAY, {"Att_Status_Id": None}),
        (6, 10, None, {}), (7, 10, DAY, {"Late_By_Mins": 0, "Att_Status_Id": 5})])
    rows = {r["attendance_id"]: r for r in dicts(frame)}
    assert sorted(rows) == [1, 2, 3, 4, 5, 7]
    flags = {k: (r["is_late"], r["is_early_leave"], r["is_absent"], r["has_overtime"])
             for k, r in rows.items()}
    assert flags == {1: (False, False, False, False), 2: (True, False, False, True),
                     3: (False, True, True, False), 4: (False, False, True, False),
                     5: (False, False, False, False), 7: (False, False, True, False)}
    assert rows[1]["late_by_mins"] == 0 and rows[1]["call_back_duration"] == 0


def test_departments_activity_marks_and_blank_names(make):
    marks = ["Y", " yes ", "true", "1", "N", None, "0"]
    raw = make.raw("tppd_dept", [{"deptint_id": i, "dept_name": f" D{i} ", "active_yn": mark}
                                 for i, mark in enumerate(marks)]
                   + [{"deptint_id": 90, "dept_name": "  "}, {"deptint_id": 91}])
    rows = dicts(staging.stg_departments(raw, LOADED_AT), "department_int_id")
    assert [r["is_active"] for r in rows] == [True, True, True, True, False, False, False]
    assert rows[0]["department_name"] == "D0" and rows[0]["lunch_break_mins"] == 30


def test_employees_are_distinct_untrimmed_people(make):
    line = {"Employee ID": "A", "emp_Int_id": "1", "First Name": " Ann", "Corp_Id": 1}
    raw = make.raw("crmc_payrollfile", [line, line, {**line, "First Name": "Ann"},
                                        {"Employee ID": None}])
    rows = dicts(staging.stg_employees(raw, LOADED_AT), "first_name")
    assert [r["first_name"] for r in rows] == [" Ann", "Ann"]


def test_payroll_keeps_cost_amounts_as_text(make):
    rows = dicts(make.benefits([{"Employee ID": "A", "Employer Cost": " $5 ",
                                 "Current Arrears": "12.5"}, {"Employee ID": None}]))
    assert len(rows) == 1 and rows[0]["employer_cost"] == "$5"
    assert rows[0]["current_arrears"] == Decimal("12.50") and rows[0]["total_arrears"] is None


def test_pay_defaults(make):
    rows = dicts(make.pay([(1, 5, DAY, {"esign_yn": True}), (2, None, DAY, {})]))
    assert len(rows) == 1
    assert rows[0]["gross_pay"] == 0 and rows[0]["hours_401k"] == 0
    assert rows[0]["has_esign"] is True and rows[0]["flsa_method"] is False


def test_workforce_names_dates_and_defaults(make):
    frame = make.workforce([
        (1, {"First Name": " Ann ", "Last Name": " Lee", "HireDate": "2020/5/1", "DOB": "bad",
             "StatusDate": ""}),
        (2, {"First Name": None}), (3, {"EmployeeId": "  "}), (4, {"EmployeeId": None})])
    rows = dicts(frame, "employee_int_id")
    assert [r["employee_int_id"] for r in rows] == [1, 2]
    assert rows[0]["full_name"] == "Ann Lee" and rows[1]["full_name"] is None
    assert rows[0]["hire_date"] == dt.date(2020, 5, 1)
    assert rows[0]["date_of_birth"] is None and rows[0]["status_date"] is None
    assert rows[0]["standard_weekly_hours"] == 40 and rows[0]["hourly_rate"] == 0


def test_every_staging_view_handles_no_rows(make, spark):
    for name, stage in (("activity_log", staging.stg_activity_log),
                        ("thr_attendance", staging.stg_daily_attendance),
                        ("tppd_dept", staging.stg_departments),
                        ("crmc_payrollfile", staging.stg_payroll),
                        ("crmc_payrollfile", staging.stg_employees),
                        ("tpp_tc_main", staging.stg_payroll_main),
                        ("workforcetable_rpt", staging.stg_workforce)):
        assert stage(make.raw(name, [])).count() == 0
