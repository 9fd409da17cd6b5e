"""Schemas of the raw tables, for readers and for hand-made rows.

Fixed values: the column names are those the source system delivers.  Types the
views do not fix by a cast are our choice.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

_WEEKLY_HOURS = """
`Emp_ID` string, `emp_int_id` string, `First Name` string, `Last Name` string,
`Week Number` int, `Shift` string, `shift_int_id` int, `Total Hours` decimal(8,2),
`hours` decimal(8,2), `RATE` decimal(10,2), `Earning Code` string, `earning_number` string,
`Job Code` int, `Dept ID` int, `shiff_diff_yn` boolean"""

RAW_DDL: dict[str, str] = {
    "activity_log": """
Activity_Id bigint, Emp_Int_ID bigint, EnteredDate timestamp, Activity_Type string,
Activity_Desc string, ModuleName string, EffectedTableName string, EffectedColumnName string,
EnterBy string, User_Role string, StartTime timestamp, EndTime timestamp, SystemIP string,
PublicIP string, Corp_ID int""",
    "attendance_031820": _WEEKLY_HOURS,
    "attendance_031920": _WEEKLY_HOURS,
    "thr_attendance": """
Att_Int_Id bigint, Emp_Int_Id bigint, Shift_Id bigint, Att_For_Date date,
Actual_In_Time timestamp, In_Time timestamp, Out_Time timestamp, Planned_End_Time timestamp,
Att_Status_Id int, Att_Status_Id_Original int, First_Half_Status string,
Second_Half_Status string, Time_Mgt_Code string, Late_By_Mins int, Early_Left_By_Mins int,
Absent_Minutes int, Shift_Work_Duration int, Shift_Work_Net_Duration int, Total_Duration int,
Total_Net_Duration int, Pay_Duration int, OT_Start_Time timestamp, OT_End_Time timestamp,
OT_Duration int, OT_Net_Duration int, OT_Duration_Actual int,
Shift_Allowed_Break_Duration int, Shift_Break_Duration int, Taken_Paid_Break_Duration int,
Taken_Un_Paid_Break_Duration int, Total_Break_Duration int, On_Call_Duration int,
Call_Back_Duration int, HR_Flag string, Entered_By bigint, Entered_Date timestamp""",
    "tppd_dept": """
deptint_id bigint, corp_id int, corp_mnec string, dept_mnec string, dept_num string,
dept_name string, class int, type int, pattern int, active_yn string, Lunch_Break_Mins int,
created_dt timestamp, created_by string, lst_mod_dt timestamp, lst_mod_user string""",
    "crmc_payrollfile": """
`Employee ID` string, `emp_Int_id` string, `First Name` string, `Last Name` string,
`Benefit Plan Type` string, `Benefit Plan Name` string, `Benefit Class Name` string,
`Coverage Tier Name (No Codes)` string, `Relationship (No Codes)` string,
`Cost Tier Effective Date` string, `Coverage Amount 1` string, `Coverage Amount 2` string,
`Per Pay Period Amount 1` string, `Per Pay Period Amount 2` string, `Employer Cost` string,
`Employer Cost Per Pay Period` string, `Current Arrears` decimal(12,2),
`Total Arrears` decimal(12,2), `No of PP` int, `arrears_assigned_yn` boolean, `Type` string,
`Reason` string, `Age` int, `Corp_Id` int""",
    "tpp_tc_main": """
tcpaywrk_int_id bigint, tcpaydt_int_id bigint, emp_int_id bigint, tc_dt date, pay_dt date,
chk_dt date, gross_pay decimal(12,2), gross_pay_ytd decimal(12,2), net_pay decimal(12,2),
deductions decimal(12,2), deductions_ytd decimal(12,2), emptaxes decimal(12,2),
emptaxes_ytd decimal(12,2), empr_taxes decimal(12,2), emprtaxes_ytd decimal(12,2),
empr_amt decimal(12,2), empr_amtytd decimal(12,2), check_amt decimal(12,2),
ddeposit_amt decimal(12,2), total_hrs decimal(8,2), total_hrs_ytd decimal(8,2),
hrs_401k decimal(8,2), hrs_401k_ytd decimal(8,2), check_num string, check_comment string,
deposit_type int, pyrl_sts string, paymt_sts string, paymt_sts_dt date, tc_sts string,
pyrl_type string, emp_pyrl_type string, flsa_mthd_yn boolean, esign_yn boolean,
ach_genrated_yn boolean, ReleasePayslip boolean, pyrl_comments string, bank_mnec string,
created_dt timestamp, lst_mod_dt timestamp""",
    "workforcetable_rpt": """
emp_int_id bigint, EmployeeId string, `First Name` string, `Last Name` string,
EmployeeType string, EmployeeStatus string, DOB string, HireDate string, StatusDate string,
Gender string, DepartmentNumber string, DepartmentName string, `Dept Manager` string,
ReportingManager string, `Time Card Approver` string, JobCode string, JobCodeName string,
standrd_wk_hours decimal(8,2), shift_hrs decimal(8,2), hrs_define_fte decimal(8,2),
FLSAExempt string, OVTApplicable string, ShiftDiffApplicable string,
`Attendance Exemption` string, exempttype_desc string, NurseType string,
`Payroll Type` string, Emprate decimal(10,2), PTO decimal(10,2), SICK decimal(10,2),
CPTO decimal(10,2), SICK2 decimal(10,2), tcpaydt_int_id bigint""",
}


def raw_schema(table: str) -> StructType:
    """A raw table's schema; needs a running session to parse it."""
    return StructType.fromDDL(RAW_DDL[table])
