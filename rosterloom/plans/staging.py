"""Staging views: typed, trimmed, renamed and filtered raw tables.

Every function maps raw frames to one lazy frame with ``source_table`` and
``_loaded_at`` appended.  ``loaded_at`` defaults to the query time, which is
what a view's timestamp means; pass a value to make results reproducible.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rosterloom.functions import (
    as_integer,
    full_name,
    parse_date,
    quoted,
    trimmed,
    zero_if_null,
)

LoadedAt = dt.datetime | None


def _typed(columns: Mapping[str, str], target: str) -> list[Column]:
    return [quoted(source).cast(target).alias(name) for name, source in columns.items()]


def _renamed(columns: Mapping[str, str]) -> list[Column]:
    return [quoted(source).alias(name) for name, source in columns.items()]


def _trimmed(columns: Mapping[str, str]) -> list[Column]:
    return [trimmed(source).alias(name) for name, source in columns.items()]


def _zeroed(columns: Mapping[str, str]) -> list[Column]:
    return [zero_if_null(quoted(source)).alias(name) for name, source in columns.items()]


def _integers(raw: DataFrame, columns: Mapping[str, str]) -> list[Column]:
    types = {field.name.lower(): field.dataType for field in raw.schema.fields}
    return [as_integer(quoted(source), types[source.lower()]).alias(name)
            for name, source in columns.items()]


def _flag(condition: Column) -> Column:
    """True or false; an unknown condition is false."""
    return F.coalesce(condition, F.lit(False))


def _stamped(frame: DataFrame, source_table: str, loaded_at: LoadedAt) -> DataFrame:
    moment = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    return frame.select("*", F.lit(source_table).alias("source_table"),
                        moment.alias("_loaded_at"))


def stg_activity_log(raw: DataFrame, loaded_at: LoadedAt = None) -> DataFrame:
    rows = raw.where(F.col("Activity_Id").isNotNull())
    return _stamped(rows.select(
        *_typed({"activity_id": "Activity_Id", "employee_id": "Emp_Int_ID"}, "string"),
        *_typed({"activity_timestamp": "EnteredDate"}, "timestamp"),
        *_typed({"activity_type": "Activity_Type", "activity_description": "Activity_Desc",
                 "module": "ModuleName", "affected_table": "EffectedTableName",
                 "affected_column": "EffectedColumnName", "entered_by": "EnterBy",
                 "user_role": "User_Role"}, "string"),
        *_typed({"start_time": "StartTime", "end_time": "EndTime"}, "timestamp"),
        *_typed({"system_ip": "SystemIP", "public_ip": "PublicIP"}, "string"),
        *_integers(raw, {"corp_id": "Corp_ID"}),
    ), "activity_log", loaded_at)


def _weekly_hours(raw: DataFrame, source_table: str, loaded_at: LoadedAt) -> DataFrame:
    rows = raw.where(F.col("Emp_ID").isNotNull())
    return _stamped(rows.select(
        *_typed({"employee_id": "Emp_ID", "employee_int_id": "emp_int_id"}, "string"),
        *_trimmed({"first_name": "First Name", "last_name": "Last Name"}),
        *_integers(raw, {"week_number": "Week Number"}),
        *_trimmed({"shift": "Shift"}),
        *_integers(raw, {"shift_int_id": "shift_int_id"}),
        *_typed({"total_hours": "Total Hours", "hours": "hours"}, "decimal(8,2)"),
        *_typed({"rate": "RATE"}, "decimal(10,2)"),
        *_trimmed({"earning_code": "Earning Code", "earning_number": "earning_number"}),
        *_integers(raw, {"job_code": "Job Code", "dept_id": "Dept ID"}),
        *_typed({"shift_diff_flag": "shiff_diff_yn"}, "boolean"),
    ), source_table, loaded_at)


def stg_attendance(raw_tables: Mapping[str, DataFrame], loaded_at: LoadedAt = None) -> DataFrame:
    """All weekly-hours tables, one under another; keys name the source table."""
    parts: Iterable[DataFrame] = (
        _weekly_hours(raw, name, loaded_at) for name, raw in raw_tables.items())
    return reduce(DataFrame.unionByName, parts)


def stg_daily_attendance(raw: DataFrame, loaded_at: LoadedAt = None) -> DataFrame:
    rows = raw.where(F.col("Att_For_Date").isNotNull())
    return _stamped(rows.select(
        *_renamed({"attendance_id": "Att_Int_Id", "employee_int_id": "Emp_Int_Id"}),
        *_typed({"shift_id": "Shift_Id"}, "long"),
        *_renamed({"attendance_date": "Att_For_Date", "actual_in_time": "Actual_In_Time",
                   "scheduled_in_time": "In_Time", "out_time": "Out_Time",
                   "planned_end_time": "Planned_End_Time",
                   "attendance_status_id": "Att_Status_Id",
                   "original_status_id": "Att_Status_Id_Original"}),
        *_trimmed({"first_half_status": "First_Half_Status",
                   "second_half_status": "Second_Half_Status",
                   "time_mgt_code": "Time_Mgt_Code"}),
        *_zeroed({"late_by_mins": "Late_By_Mins", "early_left_by_mins": "Early_Left_By_Mins",
                  "absent_minutes": "Absent_Minutes",
                  "shift_work_duration": "Shift_Work_Duration",
                  "shift_work_net_duration": "Shift_Work_Net_Duration",
                  "total_duration": "Total_Duration",
                  "total_net_duration": "Total_Net_Duration",
                  "pay_duration": "Pay_Duration"}),
        *_renamed({"ot_start_time": "OT_Start_Time", "ot_end_time": "OT_End_Time"}),
        *_zeroed({"ot_duration": "OT_Duration", "ot_net_duration": "OT_Net_Duration",
                  "ot_actual_duration": "OT_Duration_Actual",
                  "allowed_break_mins": "Shift_Allowed_Break_Duration",
                  "shift_break_mins": "Shift_Break_Duration",
                  "taken_paid_break_mins": "Taken_Paid_Break_Duration",
                  "taken_unpaid_break_mins": "Taken_Un_Paid_Break_Duration",
                  "total_break_mins": "Total_Break_Duration",
                  "on_call_duration": "On_Call_Duration",
                  "call_back_duration": "Call_Back_Duration"}),
        _flag(F.col("Late_By_Mins") > 0).alias("is_late"),
        _flag(F.col("Early_Left_By_Mins") > 0).alias("is_early_leave"),
        _flag((F.col("Absent_Minutes") > 0) | F.col("Att_Status_Id").isin(2, 3, 5))
        .alias("is_absent"),
        _flag(F.col("OT_Duration") > 0).alias("has_overtime"),
        *_renamed({"hr_flag": "HR_Flag"}),
        *_typed({"entered_by": "Entered_By"}, "long"),
        *_renamed({"entered_date": "Entered_Date"}),
    ), "thr_attendance", loaded_at)


def stg_departments(raw: DataFrame, loaded_at: LoadedAt = None) -> DataFrame:
    rows = raw.where(F.trim("dept_name") != "")
    return _stamped(rows.select(
        *_renamed({"department_int_id": "deptint_id", "corp_id": "corp_id"}),
        *_trimmed({"corp_code": "corp_mnec", "department_code": "dept_mnec",
                   "department_number": "dept_num", "department_name": "dept_name"}),
        *_integers(raw, {"department_class": "class", "department_type": "type",
                         "department_pattern": "pattern"}),
        _flag(F.upper(F.trim("active_yn")).isin("Y", "YES", "TRUE", "1")).alias("is_active"),
        F.coalesce("Lunch_Break_Mins", F.lit(30)).alias("lunch_break_mins"),
        *_renamed({"created_date": "created_dt", "created_by": "created_by",
                   "last_modified_date": "lst_mod_dt", "last_modified_by": "lst_mod_user"}),
    ), "tppd_dept", loaded_at)


def stg_employees(raw: DataFrame, loaded_at: LoadedAt = None) -> DataFrame:
    """Distinct people of the benefits file; constants are added after the distinct."""
    rows = raw.where(quoted("Employee ID").isNotNull())
    return _stamped(rows.select(
        *_renamed({"employee_id": "Employee ID", "employee_int_id": "emp_Int_id",
                   "first_name": "First Name", "last_name": "Last Name",
                   "corp_id": "Corp_Id"}),
    ).distinct(), "crmc_payrollfile", loaded_at)


def stg_payroll(raw: DataFrame, loaded_at: LoadedAt = None) -> DataFrame:
    """Benefit enrolment lines; cost amounts stay text, as delivered."""
    rows = raw.where(quoted("Employee ID").isNotNull())
    return _stamped(rows.select(
        *_typed({"employee_id": "Employee ID", "employee_int_id": "emp_Int_id"}, "string"),
        *_trimmed({"first_name": "First Name", "last_name": "Last Name",
                   "benefit_plan_type": "Benefit Plan Type",
                   "benefit_plan_name": "Benefit Plan Name",
                   "benefit_class_name": "Benefit Class Name",
                   "coverage_tier": "Coverage Tier Name (No Codes)",
                   "relationship": "Relationship (No Codes)",
                   "cost_tier_effective_date": "Cost Tier Effective Date",
                   "coverage_amount_1": "Coverage Amount 1",
                   "coverage_amount_2": "Coverage Amount 2",
                   "per_pay_period_amount_1": "Per Pay Period Amount 1",
                   "per_pay_period_amount_2": "Per Pay Period Amount 2",
                   "employer_cost": "Employer Cost",
                   "employer_cost_per_pay_period": "Employer Cost Per Pay Period"}),
        *_typed({"current_arrears": "Current Arrears", "total_arrears": "Total Arrears"},
                "decimal(12,2)"),
        *_integers(raw, {"num_pay_periods": "No of PP"}),
        *_typed({"arrears_assigned": "arrears_assigned_yn"}, "boolean"),
        *_trimmed({"record_type": "Type", "reason": "Reason"}),
        *_integers(raw, {"age": "Age", "corp_id": "Corp_Id"}),
    ), "crmc_payrollfile", loaded_at)


def stg_payroll_main(raw: DataFrame, loaded_at: LoadedAt = None) -> DataFrame:
    rows = raw.where(F.col("emp_int_id").isNotNull())
    return _stamped(rows.select(
        *_renamed({"payroll_work_id": "tcpaywrk_int_id", "payroll_date_id": "tcpaydt_int_id",
                   "employee_int_id": "emp_int_id", "timecard_date": "tc_dt",
                   "pay_date": "pay_dt", "check_date": "chk_dt"}),
        *_zeroed({"gross_pay": "gross_pay", "gross_pay_ytd": "gross_pay_ytd",
                  "net_pay": "net_pay", "deductions": "deductions",
                  "deductions_ytd": "deductions_ytd", "employee_taxes": "emptaxes",
                  "employee_taxes_ytd": "emptaxes_ytd", "employer_taxes": "empr_taxes",
                  "employer_taxes_ytd": "emprtaxes_ytd", "employer_amount": "empr_amt",
                  "employer_amount_ytd": "empr_amtytd", "total_hours": "total_hrs",
                  "total_hours_ytd": "total_hrs_ytd", "hours_401k": "hrs_401k",
                  "hours_401k_ytd": "hrs_401k_ytd"}),
        *_trimmed({"check_number": "check_num", "check_comment": "check_comment"}),
        *_zeroed({"check_amount": "check_amt", "direct_deposit_amount": "ddeposit_amt"}),
        *_integers(raw, {"deposit_type": "deposit_type"}),
        *_renamed({"payroll_status": "pyrl_sts", "payment_status": "paymt_sts",
                   "payment_status_date": "paymt_sts_dt", "timecard_status": "tc_sts",
                   "payroll_type": "pyrl_type", "employee_payroll_type": "emp_pyrl_type"}),
        _flag(F.col("flsa_mthd_yn")).alias("flsa_method"),
        _flag(F.col("esign_yn")).alias("has_esign"),
        _flag(F.col("ach_genrated_yn")).alias("ach_generated"),
        _flag(F.col("ReleasePayslip")).alias("payslip_released"),
        *_trimmed({"payroll_comments": "pyrl_comments", "bank_code": "bank_mnec"}),
        *_renamed({"created_date": "created_dt", "last_modified_date": "lst_mod_dt"}),
    ), "tpp_tc_main", loaded_at)


def stg_workforce(raw: DataFrame, loaded_at: LoadedAt = None) -> DataFrame:
    rows = raw.where(F.trim("EmployeeId") != "")
    return _stamped(rows.select(
        *_typed({"employee_int_id": "emp_int_id"}, "long"),
        *_trimmed({"employee_id": "EmployeeId", "first_name": "First Name",
                   "last_name": "Last Name"}),
        full_name(trimmed("First Name"), trimmed("Last Name")).alias("full_name"),
        *_trimmed({"employee_type": "EmployeeType", "employee_status": "EmployeeStatus"}),
        parse_date(F.col("DOB")).alias("date_of_birth"),
        parse_date(F.col("HireDate")).alias("hire_date"),
        parse_date(F.col("StatusDate")).alias("status_date"),
        *_trimmed({"gender": "Gender", "department_number": "DepartmentNumber",
                   "department_name": "DepartmentName", "dept_manager": "Dept Manager",
                   "reporting_manager": "ReportingManager",
                   "time_card_approver": "Time Card Approver", "job_code": "JobCode",
                   "job_code_name": "JobCodeName"}),
        F.coalesce("standrd_wk_hours", F.lit(Decimal("40.0"))).alias("standard_weekly_hours"),
        *_renamed({"shift_hours": "shift_hrs", "hours_define_fte": "hrs_define_fte"}),
        *_trimmed({"flsa_exempt": "FLSAExempt", "ovt_applicable": "OVTApplicable",
                   "shift_diff_applicable": "ShiftDiffApplicable",
                   "attendance_exemption": "Attendance Exemption",
                   "exempt_type_desc": "exempttype_desc", "nurse_type": "NurseType",
                   "payroll_type": "Payroll Type"}),
        *_zeroed({"hourly_rate": "Emprate", "pto_balance": "PTO", "sick_balance": "SICK",
                  "cpto_balance": "CPTO", "sick2_balance": "SICK2"}),
        *_renamed({"tcpaydt_int_id": "tcpaydt_int_id"}),
    ), "workforcetable_rpt", loaded_at)
