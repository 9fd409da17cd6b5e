"""SQL common table expressions: the raw tables, and the views over them.

Written for DuckDB, apart from the DataFrame code, in the plain form: joins
are not collapsed, distinct counts are not rewritten, nothing is pre-aggregated.
"""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"
ACTIVITY_AS_OF = "TIMESTAMP '2024-01-31'"


def rnd(x: str, n: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), {n}) AS DOUBLE)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def txt(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def pct0(a: str, b: str, n: int = 1) -> str:
    """Percentage, zero without a positive denominator."""
    return f"CASE WHEN ({b}) > 0 THEN {rnd(f'100.0 * CAST({a} AS DOUBLE) / ({b})', n)} ELSE 0.0 END"


def per0(a: str, b: str, n: int) -> str:
    return f"CASE WHEN ({b}) > 0 THEN {rnd(f'CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE)', n)} ELSE 0.0 END"


def pctn(a: str, b: str, n: int = 1) -> str:
    """Percentage, null for a zero denominator."""
    return rnd(f"100.0 * CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)", n)


def fname(k: str) -> str:
    return f"['Ada','Ben','Cora','Dan','Eve'][({k}) % 5 + 1]"


def lname(k: str) -> str:
    return f"CAST(CASE WHEN ({k}) % 50 = 5 THEN ({k}) - 5 ELSE ({k}) END AS VARCHAR)"


def cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def money(x: str, p: int = 12) -> str:
    return f"CAST(({x}) / 100.0 AS DECIMAL({p},2))"


def ago(days: str) -> str:
    return f"({AS_OF} - CAST({days} AS INTEGER))"


def _wf_date(days: str) -> str:
    d = ago(days)
    return (f"CASE WHEN k % 101 = 7 THEN NULL WHEN k % 89 = 5 THEN 'unknown' "
            f"WHEN k % 11 = 3 THEN strftime({d}, '%Y/%m/%d') ELSE CAST({d} AS VARCHAR) END")


def _band(v: str, limits: list[tuple[int, str]], last: str) -> str:
    cases = " ".join(f"WHEN {v} < {limit} THEN '{label}'" for limit, label in limits)
    return f"CASE WHEN {v} IS NULL THEN 'Unknown' {cases} ELSE '{last}' END"


TENURE = [(1, "< 1 Year"), (3, "1-2 Years"), (5, "3-4 Years"), (10, "5-9 Years"),
          (20, "10-19 Years")]
AGE = [(25, "Under 25"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
WEEKDAYS = "['Sunday','Monday','Tuesday','Wednesday','Thursday','Friday','Saturday']"

CTES: dict[str, str] = {}

# Raw tables.

CTES["raw_wf"] = f"""
SELECT k AS emp_int_id,
  CASE WHEN k % 97 = 0 THEN '  ' ELSE ' E' || k || ' ' END AS eid,
  ' ' || {fname('k')} AS fn, {lname('k')} || ' ' AS ln,
  ['Full Time','Part Time','PRN'][k % 3 + 1] AS etype,
  CASE WHEN k % 10 = 0 THEN 'Terminated' ELSE 'Active' END AS estatus,
  {_wf_date('k * 37 % 20500 + 6570')} AS dob,
  {_wf_date('CASE WHEN k % 40 = 1 THEN (k // 40) % 30 WHEN k % 40 = 2 THEN (k // 40) % 60 + 30 ELSE k * 13 % 9000 END')} AS hired,
  {_wf_date('CASE WHEN k % 10 = 0 THEN (k // 10) % 40 ELSE k * 3 % 4000 END')} AS changed,
  CASE WHEN k % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  'D' || dk || CASE WHEN k % 5 = 0 THEN 'B' ELSE 'A' END AS dnum,
  CASE WHEN k % 53 <> 0 THEN ['ICU','Emergency','Surgery','Labor and Delivery','Pediatrics','Medical','Oncology','Radiology','Pharmacy','Records'][dk % 10 + 1] || ' ' || n_name END AS dname,
  'Head of ' || n_name AS dmgr,
  CASE WHEN k % 61 <> 0 THEN {fname('m')} || ' ' || {lname('m')} END AS rmgr,
  'J' || (k % 8) AS jcode,
  ['Registered Nurse','RN Charge','Licensed Practical Nurse','Certified Nursing Assistant','Physician','Nurse Practitioner','Radiology Technician','Clerk'][k % 8 + 1] AS jname,
  CASE WHEN k % 9 <> 0 THEN CAST(k % 3 * 2 + 36 AS DECIMAL(8,2)) END AS wk,
  CAST(k % 3 * 4 + 4 AS DECIMAL(8,2)) AS sh, CAST(40 AS DECIMAL(8,2)) AS fte,
  CASE WHEN k % 4 = 0 THEN 'Y' ELSE 'N' END AS flsa, CASE WHEN k % 3 = 0 THEN 'Y' ELSE 'N' END AS ovt,
  CASE WHEN k % 2 = 0 THEN 'Y' ELSE 'N' END AS sdiff, CASE WHEN k % 6 = 0 THEN 'Y' ELSE 'N' END AS attex,
  ['RN','RN','LPN','CNA','','','',''][k % 8 + 1] AS nurse, ['Hourly','Salaried'][k % 2 + 1] AS ptype,
  CASE WHEN k % 17 <> 0 THEN {money(f"abs({cents('c_acctbal')}) % 10000 + 1200", 10)} END AS rate,
  CASE WHEN k % 13 <> 0 THEN {money('k % 240 * 100 + 50', 10)} END AS pto,
  {money('k % 120 * 100 + 25', 10)} AS sick,
  CASE WHEN k % 3 <> 0 THEN {money('k % 7 * 100', 10)} END AS cpto, s + 100 AS snap
FROM (SELECT *, CASE k % 4 WHEN 0 THEN 0 WHEN 1 THEN (k // 4) % 40 + 1 WHEN 2 THEN (k // 4) % 25 + 100 ELSE (k // 4) % 100 + 200 END AS m
      FROM (SELECT c_custkey AS k, c_acctbal, s,
              (c_nationkey + CASE WHEN c_custkey % 14 = 0 AND s = 1 THEN 1 ELSE 0 END) % 25 AS dk
            FROM customer, (VALUES (0), (1)) AS v(s) WHERE s = 0 OR c_custkey % 7 = 0)) p
LEFT JOIN nation ON n_nationkey = dk"""

CTES["raw_att"] = """
SELECT *, CAST(l_quantity AS INTEGER) AS q, l_shipdate + to_hours(l_partkey % 24) AS t0
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["raw_ben"] = f"""
SELECT *, CAST(l_quantity AS INTEGER) AS q,
  {cents('l_extendedprice')} * {cents('l_discount')} // 1000 AS arr
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
WHERE l_orderkey % 173 <> 0"""

CTES["raw_wk"] = """
SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
WHERE l_orderkey % 167 <> 0"""

CTES["raw_pay"] = f"""
SELECT *, {cents('o_totalprice')} AS c, {cents('o_totalprice')} * 7 // 10 AS net,
  CASE WHEN o_orderkey % 81 > 0 THEN o_orderkey % 81 * 100 + 50 ELSE 0 END AS h
FROM orders WHERE o_orderkey % 251 <> 0"""

# Staging views.

CTES["s_log"] = """
SELECT CAST(event_id AS VARCHAR) AS activity_id, CAST(user_id AS VARCHAR) AS employee_id,
  ts AS activity_timestamp, upper(event_type) AS activity_type, props AS activity_description,
  CASE WHEN event_id % 89 <> 0 THEN event_type END AS module,
  'table_' || (event_id % 7) AS affected_table, CAST(NULL AS VARCHAR) AS affected_column,
  'user' || user_id AS entered_by, CASE WHEN user_id % 3 = 0 THEN 'admin' ELSE 'clerk' END AS user_role,
  ts AS start_time, ts + to_minutes(event_id % 60) AS end_time,
  '10.0.0.' || (user_id % 256) AS system_ip, CAST(NULL AS VARCHAR) AS public_ip,
  user_id % 5 AS corp_id, 'activity_log' AS source_table
FROM events WHERE event_id % 97 <> 0"""

CTES["s_wk"] = f"""
SELECT 'E' || o_custkey AS employee_id, CAST(o_custkey AS VARCHAR) AS employee_int_id,
  {fname('o_custkey')} AS first_name, {lname('o_custkey')} AS last_name,
  week(l_shipdate) AS week_number,
  CASE l_returnflag WHEN 'A' THEN 'Day' WHEN 'N' THEN 'Evening' ELSE 'Night' END AS shift,
  CAST(l_linenumber % 4 AS BIGINT) AS shift_int_id, CAST(l_quantity AS DECIMAL(8,2)) AS total_hours,
  CAST(greatest(l_quantity - l_linenumber % 3, 0) AS DECIMAL(8,2)) AS hours,
  CASE WHEN l_partkey % 71 <> 0 THEN {money(f"{cents('l_extendedprice')} // CAST(l_quantity AS BIGINT)", 10)} END AS rate,
  CASE WHEN l_partkey % 4 = 0 THEN 'OT' ELSE 'REG' END AS earning_code,
  CAST(l_partkey % 9 AS VARCHAR) AS earning_number, l_partkey % 8 AS job_code,
  CAST(s_nationkey AS BIGINT) AS dept_id,
  CASE WHEN l_linenumber < 7 THEN l_linenumber % 2 = 1 END AS shift_diff_flag,
  CASE l_linestatus WHEN 'O' THEN 'attendance_031820' ELSE 'attendance_031920' END AS source_table
FROM raw_wk WHERE l_linestatus IN ('O', 'F')"""

CTES["s_att"] = """
SELECT CASE WHEN l_partkey % 401 <> 0 THEN l_orderkey * 10 + l_linenumber END AS attendance_id,
  CASE WHEN l_orderkey % 199 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN o_custkey % 50 ELSE o_custkey END AS employee_int_id,
  CAST(l_linenumber % 3 + 1 AS BIGINT) AS shift_id, CAST(l_shipdate AS DATE) AS attendance_date,
  CASE WHEN l_partkey % 97 <> 0 THEN t0 + to_minutes(l_linenumber) END AS actual_in_time,
  t0 AS scheduled_in_time, t0 + to_minutes(q * 18) AS out_time, t0 + INTERVAL 8 HOUR AS planned_end_time,
  CAST(CASE WHEN l_partkey % 577 = 0 THEN NULL WHEN l_partkey % 503 = 0 THEN 8 WHEN l_quantity <= 40 THEN 1 ELSE l_linenumber END AS BIGINT) AS attendance_status_id,
  CAST(l_linenumber AS BIGINT) AS original_status_id, 'P' AS first_half_status,
  l_linestatus AS second_half_status, l_returnflag AS time_mgt_code,
  CAST(CASE WHEN l_returnflag = 'R' THEN q ELSE 0 END AS BIGINT) AS late_by_mins,
  CAST(CASE WHEN l_tax >= 0.06::DOUBLE THEN l_linenumber ELSE 0 END AS BIGINT) AS early_left_by_mins,
  0::BIGINT AS absent_minutes, 480::BIGINT AS shift_work_duration, 450::BIGINT AS shift_work_net_duration,
  CAST(CASE WHEN l_partkey % 31 = 0 THEN 0 ELSE q * 18 END AS BIGINT) AS total_duration,
  CAST(q * 17 AS BIGINT) AS total_net_duration, CAST(q * 16 AS BIGINT) AS pay_duration,
  CASE WHEN l_linestatus = 'F' THEN t0 + to_minutes(q * 18) END AS ot_start_time,
  CAST(NULL AS TIMESTAMP) AS ot_end_time,
  CAST(CASE WHEN l_linestatus = 'F' THEN q * 10 ELSE 0 END AS BIGINT) AS ot_duration,
  CAST(CASE WHEN l_linestatus = 'F' THEN q * 9 ELSE 0 END AS BIGINT) AS ot_net_duration,
  CAST(CASE WHEN l_linestatus = 'F' THEN q * 10 ELSE 0 END AS BIGINT) AS ot_actual_duration,
  30::BIGINT AS allowed_break_mins, CAST(l_linenumber * 5 AS BIGINT) AS shift_break_mins,
  15::BIGINT AS taken_paid_break_mins, 0::BIGINT AS taken_unpaid_break_mins,
  CAST(l_linenumber * 5 AS BIGINT) AS total_break_mins,
  CAST(CASE WHEN l_linenumber = 7 THEN q ELSE 0 END AS BIGINT) AS on_call_duration,
  0::BIGINT AS call_back_duration,
  l_returnflag = 'R' AND q > 0 AS is_late, l_tax >= 0.06::DOUBLE AS is_early_leave,
  l_partkey % 577 <> 0 AND l_partkey % 503 <> 0 AND l_quantity > 40 AND l_linenumber IN (2, 3, 5) AS is_absent,
  l_linestatus = 'F' AND q > 0 AS has_overtime,
  'N' AS hr_flag, l_suppkey AS entered_by, l_shipdate AS entered_date, 'thr_attendance' AS source_table
FROM raw_att"""

CTES["s_dept"] = """
SELECT CAST(n_nationkey AS BIGINT) AS department_int_id, CAST(n_regionkey AS BIGINT) AS corp_id,
  'R' || n_regionkey AS corp_code, 'N' || n_nationkey AS department_code,
  'D' || n_nationkey AS department_number, n_name AS department_name,
  CAST(n_nationkey % 3 AS BIGINT) AS department_class, CAST(n_nationkey % 4 AS BIGINT) AS department_type,
  CAST(n_nationkey % 5 AS BIGINT) AS department_pattern, n_nationkey % 6 < 4 AS is_active,
  CAST(CASE WHEN n_nationkey % 3 = 0 THEN 30 ELSE n_nationkey % 3 * 15 END AS BIGINT) AS lunch_break_mins,
  TIMESTAMP '2000-01-01' AS created_date, 'loader' AS created_by,
  TIMESTAMP '2000-01-01' AS last_modified_date, 'loader' AS last_modified_by,
  'tppd_dept' AS source_table
FROM nation WHERE n_nationkey % 12 NOT IN (10, 11)"""

CTES["s_emp"] = f"""
SELECT DISTINCT 'E' || o_custkey AS employee_id, CAST(o_custkey AS VARCHAR) AS employee_int_id,
  ' ' || {fname('o_custkey')} AS first_name, {lname('o_custkey')} AS last_name,
  o_custkey % 5 AS corp_id, 'crmc_payrollfile' AS source_table
FROM raw_ben"""

CTES["s_ben"] = f"""
SELECT 'E' || o_custkey AS employee_id, CAST(o_custkey AS VARCHAR) AS employee_int_id,
  {fname('o_custkey')} AS first_name, {lname('o_custkey')} AS last_name,
  CASE WHEN l_partkey % 251 <> 0 THEN p_type END AS benefit_plan_type, p_brand AS benefit_plan_name,
  'Class ' || l_returnflag AS benefit_class_name, 'Tier ' || l_linenumber AS coverage_tier,
  CASE WHEN l_linenumber % 2 = 0 THEN 'Spouse' ELSE 'Self' END AS relationship,
  strftime(l_shipdate, '%Y-%m-%d') AS cost_tier_effective_date,
  CAST(q * 1000 AS VARCHAR) AS coverage_amount_1, CAST(q * 500 AS VARCHAR) AS coverage_amount_2,
  CAST(q AS VARCHAR) AS per_pay_period_amount_1, CAST(NULL AS VARCHAR) AS per_pay_period_amount_2,
  '$' || (q * 20) AS employer_cost, '$' || q AS employer_cost_per_pay_period,
  {money('arr')} AS current_arrears,
  CASE WHEN l_partkey % 37 <> 0 THEN {money('arr * 2')} END AS total_arrears,
  CAST(l_linenumber AS BIGINT) AS num_pay_periods,
  CASE WHEN l_linenumber < 7 THEN l_linenumber % 2 = 0 END AS arrears_assigned,
  'T' || l_linestatus AS record_type, 'open' AS reason,
  CAST(CASE WHEN l_partkey % 59 <> 0 THEN p_size + 18 END AS BIGINT) AS age,
  o_custkey % 5 AS corp_id, 'crmc_payrollfile' AS source_table
FROM raw_ben"""

CTES["s_pay"] = f"""
SELECT CASE WHEN o_orderkey % 307 <> 0 THEN o_orderkey END AS payroll_work_id,
  year(o_orderdate) * 100 + month(o_orderdate) AS payroll_date_id, o_custkey AS employee_int_id,
  CAST(o_orderdate AS DATE) - 3 AS timecard_date,
  CAST(o_orderdate AS DATE) AS pay_date,
  CAST(o_orderdate AS DATE) AS check_date,
  {money('c')} AS gross_pay, {money('c * 3')} AS gross_pay_ytd, {money('net')} AS net_pay,
  CASE WHEN o_orderkey % 43 = 0 THEN 0 ELSE {money('c // 20')} END AS deductions,
  {money('c // 10')} AS deductions_ytd, {money('c * 15 // 100')} AS employee_taxes,
  {money('c * 30 // 100')} AS employee_taxes_ytd,
  CASE WHEN o_orderkey % 41 = 0 THEN 0 ELSE {money('c * 8 // 100')} END AS employer_taxes,
  {money('c * 16 // 100')} AS employer_taxes_ytd, {money('c * 3 // 100')} AS employer_amount,
  {money('c * 6 // 100')} AS employer_amount_ytd, {money('h', 8)} AS total_hours,
  {money('h * 2', 8)} AS total_hours_ytd,
  CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE CAST(o_orderkey % 9 AS DECIMAL(8,2)) END AS hours_401k,
  CAST(o_orderkey % 18 AS DECIMAL(8,2)) AS hours_401k_ytd,
  'C' || o_orderkey AS check_number, '' AS check_comment,
  CASE o_orderstatus WHEN 'F' THEN {money('net')} WHEN 'P' THEN {money('net // 2')} ELSE 0 END AS check_amount,
  CASE o_orderstatus WHEN 'O' THEN {money('net')} WHEN 'P' THEN {money('net // 2')} ELSE 0 END AS direct_deposit_amount,
  o_orderkey % 3 AS deposit_type, o_orderstatus AS payroll_status, 'OK' AS payment_status,
  CAST(o_orderdate AS DATE) AS payment_status_date, 'A' AS timecard_status,
  o_orderpriority[1:1] AS payroll_type, 'R' AS employee_payroll_type,
  o_orderkey % 4 <> 0 AND o_orderkey % 2 = 0 AS flsa_method, o_orderkey % 3 = 0 AS has_esign,
  FALSE AS ach_generated, o_orderkey % 6 <> 0 AND o_orderkey % 5 = 0 AS payslip_released,
  o_orderpriority AS payroll_comments, 'BNK' AS bank_code,
  o_orderdate AS created_date, o_orderdate AS last_modified_date, 'tpp_tc_main' AS source_table
FROM raw_pay"""

CTES["s_wf"] = """
SELECT emp_int_id AS employee_int_id, trim(eid) AS employee_id, trim(fn) AS first_name,
  trim(ln) AS last_name, trim(fn) || ' ' || trim(ln) AS full_name, etype AS employee_type,
  estatus AS employee_status, TRY_CAST(dob AS DATE) AS date_of_birth,
  TRY_CAST(hired AS DATE) AS hire_date, TRY_CAST(changed AS DATE) AS status_date, gender,
  dnum AS department_number, dname AS department_name, dmgr AS dept_manager,
  rmgr AS reporting_manager, 'Time Desk' AS time_card_approver, jcode AS job_code,
  jname AS job_code_name, coalesce(wk, 40.0) AS standard_weekly_hours, sh AS shift_hours,
  fte AS hours_define_fte, flsa AS flsa_exempt, ovt AS ovt_applicable, sdiff AS shift_diff_applicable,
  attex AS attendance_exemption, 'none' AS exempt_type_desc, nurse AS nurse_type,
  ptype AS payroll_type, coalesce(rate, 0) AS hourly_rate, coalesce(pto, 0) AS pto_balance,
  coalesce(sick, 0) AS sick_balance, coalesce(cpto, 0) AS cpto_balance,
  CAST(0 AS DECIMAL(10,2)) AS sick2_balance, CAST(snap AS BIGINT) AS tcpaydt_int_id,
  'workforcetable_rpt' AS source_table
FROM raw_wf WHERE trim(eid) <> ''"""

# Business views.

CTES["b_daily"] = f"""
SELECT a.attendance_id, a.employee_int_id, w.employee_id, w.full_name AS employee_name,
  w.department_name, w.department_number, w.job_code_name, a.attendance_date,
  year(attendance_date) AS attendance_year, month(attendance_date) AS attendance_month,
  dayofweek(attendance_date) AS day_of_week, {WEEKDAYS}[dayofweek(attendance_date) + 1] AS day_name,
  scheduled_in_time, actual_in_time, out_time, planned_end_time,
  CASE WHEN attendance_status_id BETWEEN 1 AND 7 THEN ['Present','Absent','Leave','Holiday','Half Day','Weekend','Work From Home'][attendance_status_id] ELSE 'Unknown' END AS attendance_status,
  first_half_status, second_half_status, is_late, late_by_mins, is_early_leave, early_left_by_mins,
  is_absent, absent_minutes, {", ".join(f"{rnd(f'{m} / 60.0', 2)} AS {h}" for h, m in (
      ('total_hours', 'total_duration'), ('net_hours', 'total_net_duration'), ('pay_hours', 'pay_duration'),
      ('shift_hours', 'shift_work_duration'), ('ot_hours', 'ot_duration'), ('ot_net_hours', 'ot_net_duration'),
      ('total_break_hours', 'total_break_mins'), ('on_call_hours', 'on_call_duration'),
      ('call_back_hours', 'call_back_duration')))},
  has_overtime, ot_start_time, ot_end_time, time_mgt_code, hr_flag, entered_date
FROM s_att a LEFT JOIN s_wf w USING (employee_int_id)"""

CTES["b_emp"] = """
SELECT employee_id, employee_int_id, first_name, last_name, first_name || ' ' || last_name AS full_name,
  count(DISTINCT benefit_plan_name) AS num_benefit_plans,
  string_agg(DISTINCT benefit_plan_type, ', ' ORDER BY benefit_plan_type) AS benefit_plan_types,
  sum(current_arrears) AS total_current_arrears, sum(total_arrears) AS total_arrears, max(corp_id) AS corp_id
FROM s_ben GROUP BY ALL"""

CTES["b_pay"] = f"""
SELECT p.payroll_work_id, p.employee_int_id, w.employee_id, w.full_name AS employee_name,
  w.department_name, w.department_number, w.job_code_name, w.employee_type, w.employee_status,
  timecard_date, pay_date, check_date, year(pay_date) AS pay_year, month(pay_date) AS pay_month,
  quarter(pay_date) AS pay_quarter, strftime(pay_date, '%Y-%m') AS pay_period,
  gross_pay, net_pay, gross_pay_ytd, deductions, deductions_ytd, employee_taxes, employee_taxes_ytd,
  employer_taxes, employer_taxes_ytd, employer_amount, employer_amount_ytd,
  gross_pay + employer_taxes + employer_amount AS total_employer_cost, total_hours, total_hours_ytd,
  CASE WHEN total_hours > 0 THEN {rnd('CAST(gross_pay AS DOUBLE) / CAST(total_hours AS DOUBLE)', 2)} ELSE CAST(hourly_rate AS DOUBLE) END AS effective_hourly_rate,
  hourly_rate AS base_hourly_rate,
  CASE WHEN total_hours > 0 AND hourly_rate > 0 THEN {rnd('CAST(gross_pay AS DOUBLE) / CAST(total_hours AS DOUBLE) - CAST(hourly_rate AS DOUBLE)', 2)} ELSE 0.0 END AS rate_premium,
  check_number, check_amount, direct_deposit_amount, deposit_type, payroll_status, payment_status,
  timecard_status, p.payroll_type, payslip_released, hours_401k, hours_401k_ytd, created_date,
  last_modified_date
FROM s_pay p LEFT JOIN s_wf w USING (employee_int_id) WHERE pay_date IS NOT NULL"""

CTES["b_shift"] = """
SELECT employee_id, first_name, last_name, first_name || ' ' || last_name AS full_name, shift,
  week_number, dept_id, job_code, sum(total_hours) AS total_hours, sum(hours) AS hours,
  CAST(sum(rate) AS DOUBLE) / count(rate) AS avg_rate,
  coalesce(sum(hours) FILTER (WHERE shift_diff_flag), 0) AS shift_diff_hours,
  count(*) AS record_count
FROM s_wk GROUP BY employee_id, first_name, last_name, shift, week_number, dept_id, job_code"""

CTES["b_demo"] = f"""
SELECT e.*, coalesce(r.n, 0) AS direct_reports,
  CASE WHEN coalesce(r.n, 0) = 0 THEN 'Individual Contributor' WHEN r.n < 6 THEN 'Small Team (1-5)'
       WHEN r.n < 11 THEN 'Medium Team (6-10)' WHEN r.n < 21 THEN 'Large Team (11-20)'
       ELSE 'Very Large Team (20+)' END AS manager_span,
  CASE WHEN hourly_rate > 0 THEN hourly_rate * standard_weekly_hours * 52 ELSE 0 END AS estimated_annual_salary
FROM (SELECT *, {_band('tenure_years', TENURE, '20+ Years')} AS tenure_band, {_band('age', AGE, '65+')} AS age_band
      FROM (SELECT *, 2001 - year(hire_date) AS tenure_years, 2001 - year(date_of_birth) AS age FROM s_wf)) e
LEFT JOIN (SELECT reporting_manager AS boss, count(DISTINCT employee_int_id) AS n FROM s_wf
           WHERE employee_status = 'Active' GROUP BY 1) r ON e.full_name = r.boss"""

# Metrics views.

CTES["m_daily"] = f"""
SELECT attendance_date, year(attendance_date) AS attendance_year, month(attendance_date) AS attendance_month,
  week(attendance_date) AS attendance_week, dayofweek(attendance_date) AS day_of_week,
  {WEEKDAYS}[dayofweek(attendance_date) + 1] AS day_name, department_name, department_number,
  total_records, unique_employees, present_count, absent_count, leave_count, holiday_count,
  half_day_count, late_count, early_leave_count,
  {pct0('present_count', 'total_records')} AS presence_rate,
  {pct0('absent_count', 'total_records')} AS absence_rate,
  {pct0('late_count', 'total_records')} AS late_rate,
  {rnd('tot / 60.0', 2)} AS total_hours, {rnd('pay / 60.0', 2)} AS pay_hours,
  {rnd('ot / 60.0', 2)} AS ot_hours, {rnd('brk / 60.0', 2)} AS break_hours,
  {rnd('onc / 60.0', 2)} AS on_call_hours,
  {per0('(tot / 60.0)', 'unique_employees', 2)} AS avg_hours_per_employee,
  total_late_minutes, {per0('total_late_minutes', 'late_count', 0)} AS avg_late_minutes
FROM (SELECT attendance_date, department_name, department_number,
        count(DISTINCT attendance_id) AS total_records,
        count(DISTINCT a.employee_int_id) AS unique_employees,
        {", ".join(f"count(DISTINCT CASE attendance_status_id WHEN {i} THEN attendance_id END) AS {n}" for i, n in enumerate(('present_count', 'absent_count', 'leave_count', 'holiday_count', 'half_day_count'), 1))},
        count(DISTINCT CASE WHEN is_late THEN attendance_id END) AS late_count,
        count(DISTINCT CASE WHEN is_early_leave THEN attendance_id END) AS early_leave_count,
        {big('sum(late_by_mins)')} AS total_late_minutes, {big('sum(total_duration)')} AS tot,
        {big('sum(pay_duration)')} AS pay, {big('sum(ot_duration)')} AS ot,
        {big('sum(total_break_mins)')} AS brk, {big('sum(on_call_duration)')} AS onc
      FROM s_att a LEFT JOIN s_wf w ON a.employee_int_id = w.employee_int_id
      GROUP BY 1, 2, 3)"""

CTES["m_head"] = f"""
SELECT corp_id, benefit_plan_type, count(DISTINCT employee_id) AS employee_count,
  count(*) AS enrollment_records, sum(current_arrears) AS total_current_arrears,
  sum(total_arrears) AS total_arrears,
  {rnd('CAST(sum(current_arrears) AS DOUBLE) / count(current_arrears)', 2)} AS avg_current_arrears,
  {rnd('avg(age)', 1)} AS avg_age
FROM s_ben GROUP BY 1, 2"""

CTES["m_period"] = f"""
SELECT strftime(make_date(pay_year, pay_month, 1), '%Y-%m') AS pay_period, pay_year, pay_month,
  pay_quarter, department_name, department_number, payroll_records, employees_paid,
  gross AS total_gross_pay, net AS total_net_pay,
  {rnd('CAST(gross AS DOUBLE) / n', 2)} AS avg_gross_pay, {rnd('CAST(net AS DOUBLE) / n', 2)} AS avg_net_pay,
  min_gross AS min_gross_pay, max_gross AS max_gross_pay, ded AS total_deductions,
  etax AS total_employee_taxes, rtax AS total_employer_taxes, contrib AS total_employer_contributions,
  cost AS total_employer_cost, {per0('cost', 'employees_paid', 2)} AS avg_employer_cost_per_employee,
  round(hrs, 1) AS total_hours, {rnd('CAST(hrs AS DOUBLE) / n', 1)} AS avg_hours_per_employee,
  {per0('gross', 'hrs', 2)} AS effective_hourly_rate, round(k401, 1) AS total_401k_hours,
  chk AS total_check_amount, dd AS total_dd_amount, check_payments, dd_payments,
  {pct0('dd_payments', 'employees_paid')} AS dd_adoption_rate
FROM (SELECT year(pay_date) AS pay_year, month(pay_date) AS pay_month, quarter(pay_date) AS pay_quarter,
        department_name, department_number, count(*) AS n,
        count(DISTINCT payroll_work_id) AS payroll_records,
        count(DISTINCT p.employee_int_id) AS employees_paid,
        count(DISTINCT CASE WHEN check_amount > 0 THEN p.employee_int_id END) AS check_payments,
        count(DISTINCT CASE WHEN direct_deposit_amount > 0 THEN p.employee_int_id END) AS dd_payments,
        sum(gross_pay) AS gross, sum(net_pay) AS net, min(gross_pay) AS min_gross,
        max(gross_pay) AS max_gross, sum(deductions) AS ded, sum(employee_taxes) AS etax,
        sum(employer_taxes) AS rtax, sum(employer_amount) AS contrib,
        sum(gross_pay + employer_taxes + employer_amount) AS cost, sum(total_hours) AS hrs,
        sum(hours_401k) AS k401, sum(check_amount) AS chk, sum(direct_deposit_amount) AS dd
      FROM s_pay p LEFT JOIN s_wf w ON p.employee_int_id = w.employee_int_id
      WHERE pay_date IS NOT NULL GROUP BY ALL)"""

_WF_COUNTS = {
    "total_employees": "TRUE", "active_employees": "employee_status = 'Active'",
    "terminated_employees": "employee_status = 'Terminated'",
    "full_time_count": "employee_type = 'Full Time'", "part_time_count": "employee_type = 'Part Time'",
    "prn_count": "employee_type = 'PRN'", "male_count": "gender = 'M'", "female_count": "gender = 'F'",
    "new_hires_30d": f"hire_date >= {AS_OF} - INTERVAL 30 DAY",
    "new_hires_90d": f"hire_date >= {AS_OF} - INTERVAL 90 DAY"}
_TEN = dict(zip(("tenure_under_1yr", "tenure_1_2yr", "tenure_3_4yr", "tenure_5_9yr", "tenure_10_19yr",
                 "tenure_20plus"), [x[1] for x in TENURE] + ["20+ Years"]))
_AGE = dict(zip(("age_under_25", "age_25_34", "age_35_44", "age_45_54", "age_55_64", "age_65plus"),
                [x[1] for x in AGE] + ["65+"]))


def _counts(conditions: dict[str, str]) -> str:
    return ", ".join(f"count(DISTINCT CASE WHEN {c} THEN employee_int_id END) AS {n}"
                     for n, c in conditions.items())


CTES["m_wf"] = f"""
SELECT d.*, t.* EXCLUDE (dn), a.* EXCLUDE (dn)
FROM (SELECT department_name, department_number, {_counts(_WF_COUNTS)},
        avg(2001 - year(hire_date)) AS avg_tenure_years, min(2001 - year(hire_date)) AS min_tenure_years,
        max(2001 - year(hire_date)) AS max_tenure_years,
        CAST(sum(hourly_rate) AS DOUBLE) / count(*) AS avg_hourly_rate,
        min(hourly_rate) AS min_hourly_rate, max(hourly_rate) AS max_hourly_rate,
        sum(hourly_rate * standard_weekly_hours * 52) AS total_annual_payroll_estimate,
        sum(pto_balance) AS total_pto_balance, sum(sick_balance) AS total_sick_balance,
        CAST(sum(pto_balance) AS DOUBLE) / count(*) AS avg_pto_balance,
        CAST(sum(sick_balance) AS DOUBLE) / count(*) AS avg_sick_balance
      FROM s_wf WHERE department_name IS NOT NULL GROUP BY 1, 2) d
LEFT JOIN (SELECT department_name AS dn, {_counts({n: f"tenure_band = '{b}'" for n, b in _TEN.items()})}
           FROM b_demo GROUP BY 1) t ON d.department_name = t.dn
LEFT JOIN (SELECT department_name AS dn, {_counts({n: f"age_band = '{b}'" for n, b in _AGE.items()})}
           FROM b_demo GROUP BY 1) a ON d.department_name = a.dn"""

# Alerts.

_A = "alert_type, priority, employee_id, employee_name, description, metric_value, detail"
_JOINED = (f"FROM s_att a LEFT JOIN s_wf w ON a.employee_int_id = w.employee_int_id "
           f"WHERE attendance_date >= {AS_OF} - INTERVAL 30 DAY")
_ONE = "CAST(CAST(round(CAST({} AS DECIMAL(38,6)), 1) AS DECIMAL(38,1)) AS VARCHAR)"

CTES["a_arrears"] = """
SELECT 'HIGH_ARREARS' AS alert_type, 'High' AS priority, employee_id,
  first_name || ' ' || last_name AS employee_name, 'Employee has high arrears balance' AS description,
  CAST(current_arrears AS VARCHAR) AS metric_value, 'Amount: $' || CAST(current_arrears AS VARCHAR) AS detail
FROM s_ben WHERE current_arrears > 500"""
CTES["a_late"] = f"""
SELECT 'CHRONIC_LATENESS' AS alert_type, 'Medium' AS priority, CAST(i AS VARCHAR) AS employee_id,
  full_name AS employee_name, 'Employee frequently late in last 30 days' AS description,
  CAST(n AS VARCHAR) AS metric_value, 'Late ' || n || ' times in 30 days' AS detail
FROM (SELECT a.employee_int_id AS i, full_name, count(*) AS n {_JOINED} AND is_late GROUP BY 1, 2) WHERE n > 5"""
CTES["a_absent"] = f"""
SELECT 'DEPT_HIGH_ABSENCE' AS alert_type, 'Medium' AS priority, d AS employee_id, d AS employee_name,
  'Department has high absence rate' AS description, {_ONE.format('p')} AS metric_value,
  {_ONE.format('p')} || '% absence rate' AS detail
FROM (SELECT department_name AS d, 100.0 * count(*) FILTER (WHERE is_absent) / count(*) AS p
      {_JOINED} AND department_name IS NOT NULL GROUP BY 1) WHERE p > 10"""
CTES["a_ot"] = f"""
SELECT 'EXCESSIVE_OT' AS alert_type, 'Low' AS priority, CAST(i AS VARCHAR) AS employee_id,
  full_name AS employee_name, 'Employee has excessive overtime' AS description,
  {_ONE.format('h')} AS metric_value, {_ONE.format('h')} || ' OT hours in 30 days' AS detail
FROM (SELECT a.employee_int_id AS i, full_name, CAST(sum(ot_duration) AS BIGINT) / 60.0 AS h
      {_JOINED} AND ot_duration > 0 GROUP BY 1, 2) WHERE h > 20"""
CTES["a_term"] = f"""
SELECT 'RECENT_TERMINATION' AS alert_type, 'Low' AS priority, employee_id, full_name AS employee_name,
  'Employee recently terminated' AS description, CAST(status_date AS VARCHAR) AS metric_value,
  'Terminated on ' || CAST(status_date AS VARCHAR) AS detail
FROM s_wf WHERE employee_status = 'Terminated' AND status_date >= {AS_OF} - INTERVAL 7 DAY"""
CTES["a_all"] = " UNION ALL ".join(
    f"SELECT {_A} FROM {t}" for t in ("a_arrears", "a_late", "a_absent", "a_ot", "a_term"))

# KPIs.

CTES["k_head"] = f"""
SELECT {_counts({n: _WF_COUNTS[n] for n in ('total_employees', 'active_employees', 'terminated_employees', 'new_hires_30d')})},
  count(DISTINCT department_name) AS total_departments FROM s_wf"""
CTES["k_att"] = f"""
SELECT count(DISTINCT attendance_id) AS total_attendance_records,
  count(DISTINCT employee_int_id) AS employees_with_attendance,
  count(DISTINCT CASE WHEN attendance_status_id = 1 THEN attendance_id END) AS present_days,
  count(DISTINCT CASE WHEN attendance_status_id IN (2, 3, 5) THEN attendance_id END) AS absent_days,
  count(DISTINCT CASE WHEN is_late THEN attendance_id END) AS late_arrivals,
  CAST(sum(ot_duration) AS BIGINT) / 60.0 AS total_ot_hours
FROM s_att WHERE attendance_date >= {AS_OF} - INTERVAL 30 DAY"""
CTES["k_last"] = """
SELECT pay_date, sum(gross_pay) AS total_gross_pay, sum(net_pay) AS total_net_pay,
  sum(total_hours) AS total_hours, sum(employer_taxes + employer_amount) AS total_employer_cost,
  count(DISTINCT employee_int_id) AS employees_paid
FROM s_pay WHERE pay_date = (SELECT max(pay_date) FROM s_pay) GROUP BY 1"""
CTES["k_ytd"] = """
SELECT sum(gross_pay) AS gross_pay_ytd, sum(net_pay) AS net_pay_ytd,
  sum(employer_taxes + employer_amount) AS employer_cost_ytd
FROM s_pay WHERE year(pay_date) = 2001"""

# Healthcare.

_ROLE = """CASE WHEN regexp_matches(j, '\\blpn\\b|licensed practical') THEN 'Licensed Practical Nurse'
  WHEN regexp_matches(j, '\\bcna\\b|nursing assistant') THEN 'Certified Nursing Assistant'
  WHEN regexp_matches(j, 'nurse practitioner|physician assistant|\\bcrna\\b') THEN 'Advanced Practice Provider'
  WHEN regexp_matches(j, '\\brn\\b|registered nurse') THEN 'Registered Nurse'
  WHEN regexp_matches(j, 'physician|surgeon') THEN 'Physician'
  WHEN regexp_matches(j, 'technician|technologist') THEN 'Technician' ELSE 'Other' END"""
_UNIT = """CASE WHEN regexp_matches(d, '\\bicu\\b|critical care|intensive') THEN 'ICU/Critical Care'
  WHEN regexp_matches(d, '\\ber\\b|emergency') THEN 'Emergency Department'
  WHEN regexp_matches(d, 'surg|operating room') THEN 'Surgical Services'
  WHEN regexp_matches(d, 'labor|delivery|obstetric') THEN 'Labor & Delivery'
  WHEN regexp_matches(d, 'pediatric') THEN 'Pediatrics' ELSE 'General Care' END"""

CTES["h_people"] = f"""
SELECT employee_int_id, employee_id, full_name, department_name AS department, {_ROLE} AS clinical_role,
  {_UNIT} AS care_unit_type, employee_status AS employment_status, hire_date
FROM (SELECT *, lower(job_code_name) AS j, lower(department_name) AS d,
        row_number() OVER (PARTITION BY employee_int_id ORDER BY tcpaydt_int_id DESC) AS rn FROM s_wf)
WHERE rn = 1"""
CTES["h_staff"] = f"""
SELECT p.employee_int_id, employee_id, full_name, department, clinical_role, care_unit_type,
  employment_status, 2001 - year(hire_date) AS tenure_years,
  {rnd('coalesce(ot, 0) / 60.0', 2)} AS ytd_overtime_hours,
  {pctn('coalesce(ot, 0)', 'wk', 2)} AS overtime_percentage,
  {pctn('pr', 'n')} AS attendance_rate_pct,
  CASE WHEN coalesce(ot, 0) / 60.0 >= 40 THEN 'High Risk' WHEN coalesce(ot, 0) / 60.0 >= 20 THEN 'Moderate Risk'
       ELSE 'Low Risk' END AS burnout_risk_level
FROM h_people p LEFT JOIN (
  SELECT employee_int_id, {big('sum(ot_duration)')} AS ot, {big('sum(total_duration)')} AS wk,
    count(*) FILTER (WHERE attendance_status_id = 1) AS pr, count(*) AS n
  FROM s_att WHERE attendance_date BETWEEN DATE '2001-01-01' AND {AS_OF} GROUP BY 1) x
ON p.employee_int_id = x.employee_int_id"""
CTES["h_shift"] = """
SELECT *, shift_type IN ('Evening Shift', 'Night Shift') OR day_type = 'Weekend' AS has_differential
FROM (SELECT attendance_date, a.employee_int_id, employee_id, department,
        coalesce(clinical_role, 'Other') AS clinical_role,
        coalesce(care_unit_type, 'General Care') AS care_unit_type,
        CASE WHEN t IS NULL THEN 'Unknown' WHEN hour(t) BETWEEN 6 AND 13 THEN 'Day Shift'
             WHEN hour(t) BETWEEN 14 AND 21 THEN 'Evening Shift' ELSE 'Night Shift' END AS shift_type,
        CASE WHEN isodow(attendance_date) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
        total_duration AS worked_minutes, ot_duration AS overtime_minutes,
        total_duration > 720 AS is_extended_shift
      FROM (SELECT *, coalesce(actual_in_time, scheduled_in_time) AS t FROM s_att) a
      LEFT JOIN h_people p ON a.employee_int_id = p.employee_int_id)"""
CTES["h_cover"] = f"""
SELECT week_start_date, year_month, department, shift_type, day_type, staff_count, shift_count,
  {rnd('w / 60.0', 2)} AS total_hours_worked, {rnd('w / 60.0 / shift_count', 2)} AS avg_hours_per_shift,
  {rnd('o / 60.0', 2)} AS total_overtime_hours, {pctn('o', 'w', 2)} AS overtime_pct,
  extended_shifts_count, shifts_with_differential,
  {pctn('shifts_with_differential', 'shift_count', 2)} AS differential_pct
FROM (SELECT CAST(date_trunc('week', attendance_date) AS DATE) AS week_start_date,
        strftime(attendance_date, '%Y-%m') AS year_month, department, shift_type, day_type,
        count(DISTINCT employee_int_id) AS staff_count, count(*) AS shift_count,
        {big('sum(worked_minutes)')} AS w, {big('sum(overtime_minutes)')} AS o,
        count(*) FILTER (WHERE is_extended_shift) AS extended_shifts_count,
        count(*) FILTER (WHERE has_differential) AS shifts_with_differential
      FROM h_shift GROUP BY 1, 2, 3, 4, 5)"""


def _avg(x: str, n: int) -> str:
    """Mean of values with at most two decimals, exactly."""
    return rnd(f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) / count({x})", n)


CTES["h_metrics"] = f"""
SELECT clinical_role, care_unit_type, department, employment_status, count(*) AS staff_count,
  count(*) FILTER (WHERE employment_status = 'Active') AS active_count,
  {_avg('tenure_years', 2)} AS avg_tenure_years,
  count(*) FILTER (WHERE tenure_years < 1) AS new_hires_under_1_year,
  count(*) FILTER (WHERE tenure_years >= 5) AS experienced_staff_5plus_years,
  count(*) FILTER (WHERE burnout_risk_level = 'High Risk') AS high_burnout_risk_count,
  count(*) FILTER (WHERE burnout_risk_level = 'Moderate Risk') AS moderate_burnout_risk_count,
  {pctn("count(*) FILTER (WHERE burnout_risk_level <> 'Low Risk')", 'count(*)')} AS burnout_risk_pct,
  {_avg('attendance_rate_pct', 2)} AS avg_attendance_rate,
  {_avg('overtime_percentage', 2)} AS avg_overtime_pct
FROM h_staff GROUP BY 1, 2, 3, 4"""
CTES["h_ratio"] = f"""
SELECT *, year(week_start_date) AS year, month(week_start_date) AS month
FROM (SELECT CAST(date_trunc('week', attendance_date) AS DATE) AS week_start_date, department,
        care_unit_type, shift_type, count(*) AS days, {rnd('avg(s)', 2)} AS avg_total_staff_count,
        min(s) AS min_total_staff_count, max(s) AS max_total_staff_count,
        {rnd('avg(r)', 2)} AS avg_rn_count, min(r) AS min_rn_count, {rnd('avg(l)', 2)} AS avg_lpn_count,
        {rnd('avg(c)', 2)} AS avg_cna_count,
        {pctn('count(*) FILTER (WHERE s < 2)', 'count(*)')} AS understaffed_days_pct,
        count(*) FILTER (WHERE care_unit_type = 'ICU/Critical Care' AND r < 2) AS days_below_min_rn_icu,
        {rnd('stddev_samp(s)', 2)} AS staff_count_stddev
      FROM (SELECT attendance_date, department, care_unit_type, shift_type,
              count(DISTINCT employee_int_id) AS s,
              count(DISTINCT CASE WHEN clinical_role = 'Registered Nurse' THEN employee_int_id END) AS r,
              count(DISTINCT CASE WHEN clinical_role = 'Licensed Practical Nurse' THEN employee_int_id END) AS l,
              count(DISTINCT CASE WHEN clinical_role = 'Certified Nursing Assistant' THEN employee_int_id END) AS c
            FROM h_shift GROUP BY 1, 2, 3, 4)
      GROUP BY 1, 2, 3, 4)"""
avg2 = _avg
