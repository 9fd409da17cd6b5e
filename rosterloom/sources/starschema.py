"""Raw workforce tables derived from a star schema in Parquet.

The views need operational HR tables; this module projects them from the
``nation customer supplier part orders lineitem events`` Parquet files, row for
row, so that every view's work grows with those files.  The choices (which rows
get a null, a blank, a second snapshot, …) only aim at covering the views'
branches.  They are restated for another engine, independently, in ``checks/``.

Projections are SQL text: one parsed expression per column keeps the driver's
share of a query small.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The reporting day of the star-schema files, and of the event file.
AS_OF = dt.date(2001, 8, 1)
ACTIVITY_AS_OF = dt.date(2024, 1, 31)

# Fixed values of the projection.
FIRST_NAMES = ("Ada", "Ben", "Cora", "Dan", "Eve")
UNITS = ("ICU", "Emergency", "Surgery", "Labor and Delivery", "Pediatrics", "Medical", "Oncology",
         "Radiology", "Pharmacy", "Records")
JOBS = ("Registered Nurse", "RN Charge", "Licensed Practical Nurse",
        "Certified Nursing Assistant", "Physician", "Nurse Practitioner",
        "Radiology Technician", "Clerk")
ACTIVE_MARKS = ("Y", " yes ", "TRUE", "1", "N", None)


def _pick(values: tuple[str | None, ...], index: str) -> str:
    items = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"element_at(array({items}), CAST(({index}) % {len(values)} + 1 AS INT))"


def _unless(key: str, divisor: int, value: str) -> str:
    """Null on every ``divisor``-th key."""
    return f"CASE WHEN {key} % {divisor} <> 0 THEN {value} END"


def _every(key: str, divisor: int, then: str, otherwise: str) -> str:
    return f"IF({key} % {divisor} = 0, {then}, {otherwise})"


def _first_name(key: str) -> str:
    return _pick(FIRST_NAMES, key)


def _last_name(key: str) -> str:
    """The key as text; one person in fifty takes a namesake's."""
    return f"CAST(IF(({key}) % 50 = 5, ({key}) - 5, ({key})) AS STRING)"


def _cents(amount: str) -> str:
    return f"CAST(round({amount} * 100) AS BIGINT)"


def _money(cents: str, precision: int = 12) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(16,0)) * 0.01BD AS DECIMAL({precision},2))"


def _columns(expressions: Mapping[str, str]) -> list[str]:
    return [f"{expression} AS `{name}`" for name, expression in expressions.items()]


class StarSchemaTables:
    """Lazy raw tables over ``<directory>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory
        self._schemas: dict[str, StructType] = {}

    def read(self, table: str) -> DataFrame:
        """A table's rows, as its files are split; its schema is read from the files once per instance."""
        path = f"{self.directory}/{table}.parquet"
        if table not in self._schemas:
            self._schemas[table] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[table]).parquet(path)

    def _lines(self) -> DataFrame:
        orders = self.read("orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
        return self.read("lineitem").join(orders, "l_orderkey")

    @cached_property
    def workforcetable_rpt(self) -> DataFrame:
        k = "c_custkey"
        people = self.read("customer").selectExpr(
            k, "c_nationkey", "c_acctbal",
            f"explode(IF({k} % 7 = 0, array(0, 1), array(0))) AS snapshot")
        people = people.selectExpr(
            "*", f"(c_nationkey + IF({k} % 14 = 0 AND snapshot = 1, 1, 0)) % 25 AS dept_key",
            f"""CASE {k} % 4 WHEN 0 THEN 0L WHEN 1 THEN ({k} div 4) % 40 + 1
                WHEN 2 THEN ({k} div 4) % 25 + 100 ELSE ({k} div 4) % 100 + 200 END AS manager""")
        nations = self.read("nation").selectExpr("n_nationkey AS dept_key", "n_name")
        people = people.join(nations, "dept_key", "left")

        def date_text(days: str) -> str:
            day = f"date_sub(DATE'{AS_OF}', CAST({days} AS INT))"
            return (f"CASE WHEN {k} % 101 = 7 THEN NULL WHEN {k} % 89 = 5 THEN 'unknown' "
                    f"WHEN {k} % 11 = 3 THEN date_format({day}, 'yyyy/MM/dd') "
                    f"ELSE CAST({day} AS STRING) END")

        hired = (f"CASE WHEN {k} % 40 = 1 THEN ({k} div 40) % 30 "
                 f"WHEN {k} % 40 = 2 THEN ({k} div 40) % 60 + 30 ELSE {k} * 13 % 9000 END")
        changed = _every(k, 10, f"({k} div 10) % 40", f"{k} * 3 % 4000")
        manager_name = f"concat({_first_name('manager')}, ' ', {_last_name('manager')})"
        return people.selectExpr(*_columns({
            "emp_int_id": k,
            "EmployeeId": _every(k, 97, "'  '", f"concat(' E', {k}, ' ')"),
            "First Name": f"concat(' ', {_first_name(k)})",
            "Last Name": f"concat({_last_name(k)}, ' ')",
            "EmployeeType": _pick(("Full Time", "Part Time", "PRN"), k),
            "EmployeeStatus": _every(k, 10, "'Terminated'", "'Active'"),
            "DOB": date_text(f"({k} * 37 % 20500 + 6570)"),
            "HireDate": date_text(f"({hired})"), "StatusDate": date_text(changed),
            "Gender": _every(k, 2, "'M'", "'F'"),
            "DepartmentNumber": f"concat('D', dept_key, {_every(k, 5, "'B'", "'A'")})",
            "DepartmentName": _unless(
                k, 53, f"concat({_pick(UNITS, 'dept_key')}, ' ', n_name)"),
            "Dept Manager": "concat('Head of ', n_name)",
            "ReportingManager": _unless(k, 61, manager_name),
            "Time Card Approver": "'Time Desk'", "JobCode": f"concat('J', {k} % 8)",
            "JobCodeName": _pick(JOBS, k),
            "standrd_wk_hours": _unless(k, 9, f"CAST({k} % 3 * 2 + 36 AS DECIMAL(8,2))"),
            "shift_hrs": f"CAST({k} % 3 * 4 + 4 AS DECIMAL(8,2))",
            "hrs_define_fte": "CAST(40 AS DECIMAL(8,2))",
            "FLSAExempt": _every(k, 4, "'Y'", "'N'"), "OVTApplicable": _every(k, 3, "'Y'", "'N'"),
            "ShiftDiffApplicable": _every(k, 2, "'Y'", "'N'"),
            "Attendance Exemption": _every(k, 6, "'Y'", "'N'"), "exempttype_desc": "' none '",
            "NurseType": _pick(("RN", "RN", "LPN", "CNA", "", "", "", ""), k),
            "Payroll Type": _pick(("Hourly", "Salaried"), k),
            "Emprate": _unless(k, 17, _money(f"abs({_cents('c_acctbal')}) % 10000 + 1200", 10)),
            "PTO": _unless(k, 13, _money(f"{k} % 240 * 100 + 50", 10)),
            "SICK": _money(f"{k} % 120 * 100 + 25", 10),
            "CPTO": _unless(k, 3, _money(f"{k} % 7 * 100", 10)),
            "SICK2": "CAST(NULL AS DECIMAL(10,2))",
            "tcpaydt_int_id": "CAST(snapshot + 100 AS BIGINT)"}))

    @cached_property
    def thr_attendance(self) -> DataFrame:
        start = "l_shipdate + make_dt_interval(0, CAST(l_partkey % 24 AS INT), {}, 0)"
        end = start.format("q * 18")
        overtime = "CASE WHEN l_linestatus = 'F' THEN {} END"
        lines = self._lines().selectExpr("*", "CAST(l_quantity AS INT) AS q")
        return lines.selectExpr(*_columns({
            "Att_Int_Id": _unless("l_partkey", 401, "l_orderkey * 10 + l_linenumber"),
            "Emp_Int_Id": _unless("l_orderkey", 199,
                                  _every("l_partkey", 3, "o_custkey % 50", "o_custkey")),
            "Shift_Id": "CAST(l_linenumber % 3 + 1 AS BIGINT)",
            "Att_For_Date": "CAST(l_shipdate AS DATE)",
            "Actual_In_Time": _unless("l_partkey", 97, start.format("l_linenumber")),
            "In_Time": start.format("0"), "Out_Time": end,
            "Planned_End_Time": start.format("480"),
            "Att_Status_Id": """CASE WHEN l_partkey % 577 = 0 THEN NULL
                WHEN l_partkey % 503 = 0 THEN 8 WHEN l_quantity <= 40 THEN 1
                ELSE l_linenumber END""",
            "Att_Status_Id_Original": "l_linenumber", "First_Half_Status": "' P '",
            "Second_Half_Status": "concat(l_linestatus, ' ')",
            "Time_Mgt_Code": "concat(' ', l_returnflag)",
            "Late_By_Mins": "CASE WHEN l_returnflag = 'R' THEN q END",
            "Early_Left_By_Mins": "CASE WHEN l_tax >= 0.06D THEN l_linenumber END",
            "Absent_Minutes": "CAST(NULL AS INT)", "Shift_Work_Duration": "480",
            "Shift_Work_Net_Duration": "450",
            "Total_Duration": _unless("l_partkey", 31, "q * 18"),
            "Total_Net_Duration": "q * 17", "Pay_Duration": "q * 16",
            "OT_Start_Time": overtime.format(end), "OT_End_Time": "CAST(NULL AS TIMESTAMP_NTZ)",
            "OT_Duration": overtime.format("q * 10"), "OT_Net_Duration": overtime.format("q * 9"),
            "OT_Duration_Actual": overtime.format("q * 10"),
            "Shift_Allowed_Break_Duration": "30", "Shift_Break_Duration": "l_linenumber * 5",
            "Taken_Paid_Break_Duration": "15", "Taken_Un_Paid_Break_Duration": "CAST(NULL AS INT)",
            "Total_Break_Duration": "l_linenumber * 5",
            "On_Call_Duration": "CASE WHEN l_linenumber = 7 THEN q END",
            "Call_Back_Duration": "CAST(NULL AS INT)", "HR_Flag": "'N'",
            "Entered_By": "l_suppkey", "Entered_Date": "l_shipdate"}))

    @cached_property
    def tpp_tc_main(self) -> DataFrame:
        k, half = "o_orderkey", _money("net div 2")
        orders = self.read("orders").selectExpr(
            "*", f"{_cents('o_totalprice')} AS cents", "CAST(o_orderdate AS DATE) AS paid",
            f"IF({k} % 81 > 0, {k} % 81 * 100 + 50, 0) AS h")
        orders = orders.selectExpr("*", "cents * 7 div 10 AS net")
        return orders.selectExpr(*_columns({
            "tcpaywrk_int_id": _unless(k, 307, k),
            "tcpaydt_int_id": "CAST(year(paid) * 100 + month(paid) AS BIGINT)",
            "emp_int_id": _unless(k, 251, "o_custkey"), "tc_dt": "date_sub(paid, 3)",
            "pay_dt": "paid", "chk_dt": "paid", "gross_pay": _money("cents"),
            "gross_pay_ytd": _money("cents * 3"), "net_pay": _money("net"),
            "deductions": _unless(k, 43, _money("cents div 20")),
            "deductions_ytd": _money("cents div 10"), "emptaxes": _money("cents * 15 div 100"),
            "emptaxes_ytd": _money("cents * 30 div 100"),
            "empr_taxes": _unless(k, 41, _money("cents * 8 div 100")),
            "emprtaxes_ytd": _money("cents * 16 div 100"), "empr_amt": _money("cents * 3 div 100"),
            "empr_amtytd": _money("cents * 6 div 100"), "total_hrs": _money("h", 8),
            "total_hrs_ytd": _money("h * 2", 8),
            "hrs_401k": _unless(k, 5, f"CAST({k} % 9 AS DECIMAL(8,2))"),
            "hrs_401k_ytd": f"CAST({k} % 18 AS DECIMAL(8,2))", "check_num": f"concat(' C', {k})",
            "check_comment": "' '",
            "check_amt": f"CASE o_orderstatus WHEN 'F' THEN {_money('net')} WHEN 'P' THEN {half} END",
            "ddeposit_amt":
                f"CASE o_orderstatus WHEN 'O' THEN {_money('net')} WHEN 'P' THEN {half} END",
            "deposit_type": f"CAST({k} % 3 AS INT)", "pyrl_sts": "o_orderstatus",
            "paymt_sts": "'OK'", "paymt_sts_dt": "paid", "tc_sts": "'A'",
            "pyrl_type": "substring(o_orderpriority, 1, 1)", "emp_pyrl_type": "'R'",
            "flsa_mthd_yn": _unless(k, 4, f"{k} % 2 = 0"), "esign_yn": f"{k} % 3 = 0",
            "ach_genrated_yn": "CAST(NULL AS BOOLEAN)",
            "ReleasePayslip": _unless(k, 6, f"{k} % 5 = 0"),
            "pyrl_comments": "concat(' ', o_orderpriority)", "bank_mnec": "'BNK '",
            "created_dt": "o_orderdate", "lst_mod_dt": "o_orderdate"}))

    @cached_property
    def crmc_payrollfile(self) -> DataFrame:
        parts = self.read("part").selectExpr("p_partkey AS l_partkey", "p_type", "p_brand", "p_size")
        lines = self._lines().join(parts, "l_partkey").selectExpr(
            "*", "CAST(l_quantity AS INT) AS q",
            f"{_cents('l_extendedprice')} * {_cents('l_discount')} div 1000 AS arrears")
        return lines.selectExpr(*_columns({
            "Employee ID": _unless("l_orderkey", 173, "concat('E', o_custkey)"),
            "emp_Int_id": "CAST(o_custkey AS STRING)",
            "First Name": f"concat(' ', {_first_name('o_custkey')})",
            "Last Name": _last_name("o_custkey"),
            "Benefit Plan Type": _unless("l_partkey", 251, "p_type"),
            "Benefit Plan Name": "concat(p_brand, ' ')",
            "Benefit Class Name": "concat('Class ', l_returnflag)",
            "Coverage Tier Name (No Codes)": "concat('Tier ', l_linenumber)",
            "Relationship (No Codes)": _every("l_linenumber", 2, "'Spouse'", "'Self'"),
            "Cost Tier Effective Date": "date_format(l_shipdate, 'yyyy-MM-dd')",
            "Coverage Amount 1": "CAST(q * 1000 AS STRING)",
            "Coverage Amount 2": "CAST(q * 500 AS STRING)",
            "Per Pay Period Amount 1": "concat(' ', q)",
            "Per Pay Period Amount 2": "CAST(NULL AS STRING)",
            "Employer Cost": "concat('$', q * 20)",
            "Employer Cost Per Pay Period": "concat('$', q)",
            "Current Arrears": _money("arrears"),
            "Total Arrears": _unless("l_partkey", 37, _money("arrears * 2")),
            "No of PP": "l_linenumber",
            "arrears_assigned_yn": "CASE WHEN l_linenumber < 7 THEN l_linenumber % 2 = 0 END",
            "Type": "concat(' T', l_linestatus)", "Reason": "'open '",
            "Age": _unless("l_partkey", 59, "p_size + 18"),
            "Corp_Id": "CAST(o_custkey % 5 AS INT)"}))

    @cached_property
    def attendance(self) -> dict[str, DataFrame]:
        """The two weekly-hours tables, by name."""
        suppliers = self.read("supplier").selectExpr("s_suppkey AS l_suppkey", "s_nationkey")
        lines = self._lines().join(suppliers, "l_suppkey")
        projection = _columns({
            "Emp_ID": _unless("l_orderkey", 167, "concat('E', o_custkey)"),
            "emp_int_id": "CAST(o_custkey AS STRING)",
            "First Name": f"concat(' ', {_first_name('o_custkey')})",
            "Last Name": f"concat({_last_name('o_custkey')}, ' ')",
            "Week Number": "weekofyear(l_shipdate)",
            "Shift": "CASE l_returnflag WHEN 'A' THEN ' Day ' WHEN 'N' THEN 'Evening ' ELSE ' Night' END",
            "shift_int_id": "l_linenumber % 4",
            "Total Hours": "CAST(CAST(l_quantity AS BIGINT) AS DECIMAL(8,2))",
            "hours": "CAST(greatest(CAST(l_quantity AS BIGINT) - l_linenumber % 3, 0) AS DECIMAL(8,2))",
            "RATE": _unless("l_partkey", 71, _money(
                f"{_cents('l_extendedprice')} div CAST(l_quantity AS BIGINT)", 10)),
            "Earning Code": _every("l_partkey", 4, "'OT '", "' REG'"),
            "earning_number": "concat(' ', l_partkey % 9)",
            "Job Code": "CAST(l_partkey % 8 AS INT)", "Dept ID": "s_nationkey",
            "shiff_diff_yn": "CASE WHEN l_linenumber < 7 THEN l_linenumber % 2 = 1 END"})
        return {"attendance_031820": lines.where("l_linestatus = 'O'").selectExpr(*projection),
                "attendance_031920": lines.where("l_linestatus = 'F'").selectExpr(*projection)}

    @cached_property
    def tppd_dept(self) -> DataFrame:
        k, moment = "n_nationkey", "TIMESTAMP_NTZ'2000-01-01 00:00:00'"
        return self.read("nation").selectExpr(*_columns({
            "deptint_id": f"CAST({k} AS BIGINT)", "corp_id": "n_regionkey",
            "corp_mnec": "concat(' R', n_regionkey)", "dept_mnec": f"concat('N', {k}, ' ')",
            "dept_num": f"concat('D', {k})",
            "dept_name": f"CASE {k} % 12 WHEN 11 THEN '   ' WHEN 10 THEN NULL "
                         "ELSE concat(' ', n_name) END",
            "class": f"{k} % 3", "type": f"{k} % 4", "pattern": f"{k} % 5",
            "active_yn": _pick(ACTIVE_MARKS, k), "Lunch_Break_Mins": _unless(k, 3, f"{k} % 3 * 15"),
            "created_dt": moment, "created_by": "'loader'", "lst_mod_dt": moment,
            "lst_mod_user": "'loader'"}))

    @cached_property
    def activity_log(self) -> DataFrame:
        k = "event_id"
        return self.read("events").selectExpr(*_columns({
            "Activity_Id": _unless(k, 97, k), "Emp_Int_ID": "user_id", "EnteredDate": "ts",
            "Activity_Type": "upper(event_type)", "Activity_Desc": "props",
            "ModuleName": _unless(k, 89, "event_type"),
            "EffectedTableName": f"concat('table_', {k} % 7)",
            "EffectedColumnName": "CAST(NULL AS STRING)", "EnterBy": "concat('user', user_id)",
            "User_Role": _every("user_id", 3, "'admin'", "'clerk'"), "StartTime": "ts",
            "EndTime": f"ts + make_dt_interval(0, 0, CAST({k} % 60 AS INT), 0)",
            "SystemIP": "concat('10.0.0.', user_id % 256)", "PublicIP": "CAST(NULL AS STRING)",
            "Corp_ID": "CAST(user_id % 5 AS INT)"}))
