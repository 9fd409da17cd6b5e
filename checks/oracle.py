"""One SQL statement per registered query."""

from __future__ import annotations

import re

from checks.tables import ACTIVITY_AS_OF, AS_OF, CTES, avg2, fname, lname, pct0, pctn, per0, rnd

_NAMES = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


# One master row per employee: the newest snapshot.
LATEST = {"s_wf": f"""SELECT * FROM ({CTES['s_wf']}) WHERE employee_int_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY employee_int_id ORDER BY tcpaydt_int_id DESC) = 1"""}


def with_tables(query: str, instead: dict[str, str] | None = None) -> str:
    """Puts the CTEs the query needs, directly or not, in front of it; some replaced by ``instead``."""
    tables, needed = CTES | (instead or {}), []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAMES.findall(text)):
            if name not in needed:
                visit(tables[name])
                if name not in needed:
                    needed.append(name)

    visit(query)
    if not needed:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({tables[n]})" for n in needed) + "\n" + query


def rows(source: str, *, doubles: str = "", bigs: str = "", texts: str = "",
         without: str = "", tail: str = "") -> str:
    """All columns of ``source``, the named ones cast for comparison."""
    casts = [f"CAST({c} AS {t}) AS {c}" for names, t in
             ((doubles, "DOUBLE"), (bigs, "BIGINT"), (texts, "VARCHAR")) for c in names.split()]
    star = "*" + (f" EXCLUDE ({', '.join(without.split())})" if without else "")
    star += f" REPLACE ({', '.join(casts)})" if casts else ""
    return f"SELECT {star} FROM {source} {tail}"


_WINDOW = f"attendance_date BETWEEN {AS_OF} - 30 AND {AS_OF}"
_PERIOD_SUMS = ("total_gross_pay total_net_pay min_gross_pay max_gross_pay total_deductions "
                "total_employee_taxes total_employer_taxes total_employer_contributions "
                "total_employer_cost total_hours total_401k_hours total_check_amount "
                "total_dd_amount")
_ACTIVE = "FROM b_demo WHERE employee_status = 'Active'"
_MAX_PERIOD = "(SELECT max(pay_period) FROM {})"
_KPI = f"""SELECT active_employees, total_employees, terminated_employees, new_hires_30d, total_departments,
  total_attendance_records AS attendance_records_30d, present_days, absent_days,
  late_arrivals AS late_arrivals_30d, {pct0('present_days', 'present_days + absent_days')} AS attendance_rate_30d,
  {rnd('total_ot_hours', 1)} AS total_ot_hours_30d, CAST(pay_date AS VARCHAR) AS latest_pay_date,
  CAST(total_gross_pay AS DOUBLE) AS latest_gross_payroll, CAST(total_net_pay AS DOUBLE) AS latest_net_payroll,
  CAST(total_employer_cost AS DOUBLE) AS latest_employer_cost, employees_paid AS latest_employees_paid,
  CAST(round(total_hours, 1) AS DOUBLE) AS latest_total_hours, CAST(gross_pay_ytd AS DOUBLE) AS ytd_gross_payroll,
  CAST(net_pay_ytd AS DOUBLE) AS ytd_net_payroll, CAST(employer_cost_ytd AS DOUBLE) AS ytd_employer_cost,
  {per0('total_gross_pay', 'active_employees', 2)} AS avg_gross_pay_per_employee,
  {per0('total_hours', 'employees_paid', 1)} AS avg_hours_per_employee
FROM k_last, k_head, k_att, k_ytd"""
_TOP_ALERTS = """SELECT alert_type, priority, employee_name, description, detail FROM a_all
ORDER BY CASE priority WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END, alert_type, employee_name,
  detail, employee_id LIMIT 20"""
_COVER_MONTH = "FROM h_cover WHERE year_month = '2001-07' GROUP BY 1, 2"


def _period_sums(pairs: dict[str, str], tail: str = "") -> str:
    sums = ", ".join(f"CAST(sum({c}) AS DOUBLE) AS {n}" for n, c in pairs.items())
    return f"SELECT pay_period, {sums} FROM m_period {tail} GROUP BY 1"


def _newest(query: str, k: int) -> str:
    return f"{query} ORDER BY pay_period DESC LIMIT {k}"


def _count_by(column: str) -> str:
    return f"SELECT {column}, count(*) AS count {_ACTIVE} GROUP BY 1"


def _imported(where: str = "") -> str:
    return f"""SELECT CASE WHEN event_id % 97 <> 0 THEN event_id END AS "Activity_Id", user_id AS "Emp_Int_ID",
  ts AS "EnteredDate", upper(event_type) AS "Activity_Type", props AS "Activity_Desc",
  CASE WHEN event_id % 89 <> 0 THEN event_type END AS "ModuleName",
  'table_' || (event_id % 7) AS "EffectedTableName", CAST(NULL AS VARCHAR) AS "EffectedColumnName",
  'user' || user_id AS "EnterBy", CASE WHEN user_id % 3 = 0 THEN 'admin' ELSE 'clerk' END AS "User_Role",
  ts AS "StartTime", ts + to_seconds(60 * (event_id % 60)) AS "EndTime",
  '10.0.0.' || (user_id % 256) AS "SystemIP", CAST(NULL AS VARCHAR) AS "PublicIP",
  CAST(user_id % 5 AS BIGINT) AS "Corp_ID" FROM events {where}"""


_RECENT_TWICE = f"WHERE ts >= {ACTIVITY_AS_OF} - INTERVAL 60 DAY"
_RECENT = f"WHERE ts >= {ACTIVITY_AS_OF} - INTERVAL 30 DAY"
_ARREARS = "(CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) // 1000)"
_BENEFITS = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"

def _burnout_groups(hours: int) -> str:
    return f"""SELECT clinical_role, department, count(*) AS staff_count,
  {avg2('ytd_overtime_hours', 1)} AS avg_overtime_hours, {avg2('overtime_percentage', 1)} AS avg_overtime_pct,
  count(*) FILTER (WHERE burnout_risk_level = 'High Risk') AS high_risk_count,
  count(*) FILTER (WHERE burnout_risk_level = 'Moderate Risk') AS moderate_risk_count
FROM h_staff WHERE employment_status = 'Active' GROUP BY 1, 2
HAVING CAST(sum(CAST(ytd_overtime_hours AS DECIMAL(18,2))) AS DOUBLE) / count(ytd_overtime_hours) > {hours}
ORDER BY avg_overtime_hours DESC, clinical_role, department NULLS LAST LIMIT 15"""


_QUERIES: dict[str, str] = {
    "a1_import_table": _imported(),
    "a1_import_window": _imported(_RECENT),
    "a2_recent_window": _imported(_RECENT),
    "a2_window_history": _imported(_RECENT_TWICE),
    "a3_clean_columns": f"""SELECT CASE WHEN l_orderkey % 173 <> 0 THEN 'E' || o_custkey END AS "Employee_ID",
  CAST(o_custkey AS VARCHAR) AS "emp_Int_id", ' ' || {fname('o_custkey')} AS "First_Name", {lname('o_custkey')} AS "Last_Name",
  CASE WHEN l_partkey % 251 <> 0 THEN p_type END AS "Benefit_Plan_Type", p_brand || ' ' AS "Benefit_Plan_Name",
  'Class ' || l_returnflag AS "Benefit_Class_Name", 'Tier ' || l_linenumber AS "Coverage_Tier_Name_(No_Codes)",
  CASE WHEN l_linenumber % 2 = 0 THEN 'Spouse' ELSE 'Self' END AS "Relationship_(No_Codes)",
  strftime(l_shipdate, '%Y-%m-%d') AS "Cost_Tier_Effective_Date",
  CAST(CAST(l_quantity AS INTEGER) * 1000 AS VARCHAR) AS "Coverage_Amount_1",
  CAST(CAST(l_quantity AS INTEGER) * 500 AS VARCHAR) AS "Coverage_Amount_2",
  ' ' || CAST(l_quantity AS INTEGER) AS "Per_Pay_Period_Amount_1", CAST(NULL AS VARCHAR) AS "Per_Pay_Period_Amount_2",
  '$' || (CAST(l_quantity AS INTEGER) * 20) AS "Employer_Cost", '$' || CAST(l_quantity AS INTEGER) AS "Employer_Cost_Per_Pay_Period",
  CAST({_ARREARS} / 100.0 AS DOUBLE) AS "Current_Arrears",
  CASE WHEN l_partkey % 37 <> 0 THEN CAST({_ARREARS} * 2 / 100.0 AS DOUBLE) END AS "Total_Arrears",
  CAST(l_linenumber AS BIGINT) AS "No_of_PP",
  CASE WHEN l_linenumber < 7 THEN l_linenumber % 2 = 0 END AS "arrears_assigned_yn", ' T' || l_linestatus AS "Type",
  'open ' AS "Reason", CASE WHEN l_partkey % 59 <> 0 THEN p_size + 18 END AS "Age",
  CAST(o_custkey % 5 AS BIGINT) AS "Corp_Id" FROM {_BENEFITS}""",
    "a4_import_many": f"""SELECT 'activity_log' AS table_name, count(*) AS row_count, 'success' AS status FROM events {_RECENT}
UNION ALL SELECT 't_1099_missing', 0, 'error'
UNION ALL SELECT 'tppd_dept', count(*), 'success' FROM nation""",
    "a5_sync_table": f"SELECT 'benefits' AS table_name, count(*) AS row_count, 'success' AS status FROM {_BENEFITS}",
    "a6_import_log": f"SELECT 'activity_log' AS table_name, count(*) AS row_count, 'success' AS status FROM events {_RECENT}",
    "a7_row_parity": f"SELECT 'benefits' AS table_name, count(*) AS source_rows, count(*) AS target_rows, TRUE AS passed FROM {_BENEFITS}",
    "a8_quality_report": """SELECT check_name, table_name, n = 0 AS passed, n || ' ' || noun AS details FROM (
  SELECT 'not_null:attendance_id' AS check_name, 'stg_daily_attendance' AS table_name,
    (SELECT count(*) FROM s_att WHERE attendance_id IS NULL) AS n, 'null values' AS noun
  UNION ALL SELECT 'not_null:attendance_date', 'stg_daily_attendance',
    (SELECT count(*) FROM s_att WHERE attendance_date IS NULL), 'null values'
  UNION ALL SELECT 'unique:attendance_id', 'stg_daily_attendance',
    (SELECT count(*) FROM (SELECT attendance_id FROM s_att WHERE attendance_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)), 'repeated keys'
  UNION ALL SELECT 'unique:employee_int_id,tcpaydt_int_id', 'stg_workforce',
    (SELECT count(*) FROM (SELECT 1 FROM s_wf GROUP BY employee_int_id, tcpaydt_int_id HAVING count(*) > 1)), 'repeated keys'
  UNION ALL SELECT 'referential:employee_int_id', 'stg_daily_attendance',
    (SELECT count(DISTINCT employee_int_id) FROM s_att WHERE employee_int_id NOT IN (SELECT employee_int_id FROM s_wf)), 'values without a parent'
  UNION ALL SELECT 'same_row_count', 'stg_daily_attendance',
    (SELECT count(*) FROM raw_att) - (SELECT count(*) FROM s_att), 'rows difference')""",
    "a8_uncastable_values": f"""SELECT 'castable:' || c AS check_name, 'crmc_payrollfile' AS table_name, n = 0 AS passed,
  n || ' bad values' AS details FROM (
  SELECT unnest(['Current Arrears', 'Total Arrears', 'No of PP', 'arrears_assigned_yn', 'Age', 'Corp_Id']) AS c,
    unnest([0, count(*) FILTER (l_linenumber = 6), 0, count(*) FILTER (l_linenumber = 5), count(*) FILTER (l_linenumber = 7), 0]) AS n
  FROM {_BENEFITS})""",
    "a9_incremental_daily": rows("m_daily", texts="attendance_date"),
    "a9_incremental_periods": rows("m_period", doubles=_PERIOD_SUMS),
    "a9_materialized_window": rows("m_daily", texts="attendance_date", tail=f"WHERE m_daily.{_WINDOW}"),
    "b6_stg_payroll_from_text": """SELECT * REPLACE (CASE WHEN num_pay_periods <> 7 THEN age END AS age,
  CASE WHEN num_pay_periods <> 6 THEN CAST(total_arrears AS DOUBLE) END AS total_arrears, CAST(current_arrears AS DOUBLE) AS current_arrears,
  CASE WHEN num_pay_periods <> 5 THEN arrears_assigned END AS arrears_assigned) FROM s_ben""",
    "s12_accepted_rows": rows("s_ben", doubles="total_arrears current_arrears", tail="WHERE num_pay_periods NOT IN (5, 6, 7)"),
    "s12_rejected_rows": f"""SELECT CASE WHEN l_orderkey % 173 <> 0 THEN 'E' || o_custkey END AS employee_id,
  CAST(o_custkey AS VARCHAR) AS employee_int_id, CAST(l_linenumber AS VARCHAR) AS num_pay_periods,
  CASE WHEN l_linenumber = 7 THEN 'n/a' WHEN l_partkey % 59 <> 0 THEN CAST(p_size + 18 AS VARCHAR) END AS age,
  CASE WHEN l_linenumber = 6 THEN '12,5' WHEN l_partkey % 37 <> 0 THEN CAST(CAST({_ARREARS} * 2 / 100.0 AS DECIMAL(18,2)) AS VARCHAR) END AS total_arrears,
  CASE WHEN l_linenumber = 5 THEN 'maybe' WHEN l_linenumber < 7 THEN CAST(l_linenumber % 2 = 0 AS VARCHAR) END AS arrears_assigned,
  CASE l_linenumber WHEN 5 THEN 'arrears_assigned_yn' WHEN 6 THEN 'Total Arrears' ELSE 'Age' END AS failed
  FROM {_BENEFITS} WHERE l_linenumber IN (5, 6, 7)""",
    "a9_keyed_employees": rows("s_emp", tail="WHERE CAST(employee_int_id AS BIGINT) % 10 <> 7"),
    "a9_materialized_view": rows("b_emp", doubles="total_current_arrears total_arrears"),
    "a9_refresh_log": "SELECT 'metrics.headcount_metrics' AS view_name, count(*) AS row_count, 'success' AS refresh_status FROM m_head",

    "b1_stg_activity_log": rows("s_log"),
    "b2_stg_attendance": rows("s_wk", doubles="total_hours hours rate"),
    "b3_stg_daily_attendance": rows("s_att", texts="attendance_date"),
    "b4_stg_departments": rows("s_dept"),
    "b5_stg_employees": rows("s_emp"),
    "b6_stg_payroll": rows("s_ben", doubles="current_arrears total_arrears"),
    "b7_stg_payroll_main": rows(
        "s_pay", doubles="gross_pay gross_pay_ytd net_pay deductions deductions_ytd employee_taxes "
        "employee_taxes_ytd employer_taxes employer_taxes_ytd employer_amount employer_amount_ytd "
        "total_hours total_hours_ytd hours_401k hours_401k_ytd check_amount direct_deposit_amount",
        texts="timecard_date pay_date check_date payment_status_date"),
    "b8_stg_workforce": rows(
        "s_wf", doubles="standard_weekly_hours shift_hours hours_define_fte hourly_rate pto_balance "
        "sick_balance cpto_balance sick2_balance", texts="date_of_birth hire_date status_date"),

    "c1_attendance_detail": """SELECT employee_id, employee_int_id, first_name, last_name,
  first_name || ' ' || last_name AS full_name, week_number, shift, CAST(total_hours AS DOUBLE) AS total_hours,
  CAST(hours AS DOUBLE) AS hours, CAST(rate AS DOUBLE) AS rate, earning_code, earning_number, job_code,
  dept_id, shift_diff_flag, source_table FROM s_wk""",
    "c2_daily_attendance_detail": rows("b_daily", texts="attendance_date"),
    "c2_daily_attendance_bucketed": rows("b_daily", texts="attendance_date"),
    "c2_daily_attendance_split": rows("b_daily", texts="attendance_date"),
    "c3_employee_summary": rows("b_emp", doubles="total_current_arrears total_arrears"),
    "c4_payroll_analytics": rows(
        "b_pay", doubles="gross_pay net_pay gross_pay_ytd deductions deductions_ytd employee_taxes "
        "employee_taxes_ytd employer_taxes employer_taxes_ytd employer_amount employer_amount_ytd "
        "total_employer_cost total_hours total_hours_ytd base_hourly_rate check_amount "
        "direct_deposit_amount hours_401k hours_401k_ytd", texts="timecard_date pay_date check_date"),
    "c5_payroll_detail": """SELECT employee_id, employee_int_id, first_name, last_name,
  first_name || ' ' || last_name AS full_name, benefit_plan_type, benefit_plan_name, benefit_class_name,
  coverage_tier, relationship, cost_tier_effective_date, coverage_amount_1, coverage_amount_2,
  per_pay_period_amount_1, per_pay_period_amount_2, employer_cost, employer_cost_per_pay_period,
  CAST(current_arrears AS DOUBLE) AS current_arrears, CAST(total_arrears AS DOUBLE) AS total_arrears,
  num_pay_periods, arrears_assigned, record_type, reason, age, corp_id, source_table FROM s_ben""",
    "c6_clinical_staff_summary": rows("b_emp", doubles="total_current_arrears total_arrears"),
    "c7_staffing_by_shift": rows("b_shift", doubles="total_hours hours shift_diff_hours"),
    "c8_workforce_demographics": """SELECT employee_int_id, employee_id, first_name, last_name, full_name,
  employee_type, employee_status, gender, CAST(hire_date AS VARCHAR) AS hire_date,
  CAST(date_of_birth AS VARCHAR) AS date_of_birth, department_number, department_name, dept_manager,
  reporting_manager, job_code, job_code_name, CAST(standard_weekly_hours AS DOUBLE) AS standard_weekly_hours,
  CAST(hourly_rate AS DOUBLE) AS hourly_rate, flsa_exempt, nurse_type, payroll_type, tenure_years, age,
  CAST(pto_balance AS DOUBLE) AS pto_balance, CAST(sick_balance AS DOUBLE) AS sick_balance, tenure_band,
  age_band, direct_reports, manager_span, CAST(estimated_annual_salary AS DOUBLE) AS estimated_annual_salary
FROM b_demo""",

    "d1_attendance_daily_metrics": rows("m_daily", texts="attendance_date"),
    "d2_attendance_metrics": f"""SELECT week_number, shift, dept_id, count(DISTINCT employee_id) AS employee_count,
  count(*) AS total_records, CAST(sum(total_hours) AS DOUBLE) AS total_hours, CAST(sum(hours) AS DOUBLE) AS hours_worked,
  {rnd('CAST(sum(total_hours) AS DOUBLE) / count(total_hours)', 2)} AS avg_hours,
  {rnd('CAST(sum(rate) AS DOUBLE) / count(rate)', 2)} AS avg_rate,
  count(*) FILTER (WHERE shift_diff_flag) AS shift_diff_count,
  CAST(coalesce(sum(hours) FILTER (WHERE shift_diff_flag), 0) AS DOUBLE) AS shift_diff_hours
FROM s_wk GROUP BY 1, 2, 3""",
    "d3_clinical_workforce_metrics": f"""SELECT corp_id, count(DISTINCT employee_id) AS employee_count,
  CAST(sum(total_current_arrears) AS DOUBLE) AS total_current_arrears,
  CAST(sum(total_arrears) AS DOUBLE) AS total_arrears,
  {rnd('avg(num_benefit_plans)', 2)} AS avg_benefit_plans_per_employee FROM b_emp GROUP BY 1""",
    "d4_department_staffing_ratios": f"""SELECT dept_id, shift, week_number, CAST(sum(record_count) AS BIGINT) AS total_records,
  count(DISTINCT employee_id) AS unique_employees, CAST(sum(total_hours) AS DOUBLE) AS total_hours,
  CAST(sum(hours) AS DOUBLE) AS hours_worked,
  {rnd('CAST(sum(total_hours) AS DOUBLE) / count(total_hours)', 2)} AS avg_hours,
  CAST(sum(shift_diff_hours) AS DOUBLE) AS shift_diff_hours FROM b_shift GROUP BY 1, 2, 3""",
    "d5_executive_alerts": "SELECT * FROM a_all",
    "d5a_high_arrears": "SELECT * FROM a_arrears",
    "d5b_chronic_lateness": "SELECT * FROM a_late",
    "d5c_department_absence": "SELECT * FROM a_absent",
    "d5d_excessive_overtime": "SELECT * FROM a_ot",
    "d5e_recent_terminations": "SELECT * FROM a_term",
    "d6_executive_kpis": _KPI,
    "d6a_headcount": "SELECT * FROM k_head",
    "d6b_attendance_30d": "SELECT * FROM k_att",
    "d6c_latest_payroll": rows("k_last", doubles="total_gross_pay total_net_pay total_hours total_employer_cost", texts="pay_date"),
    "d6d_payroll_ytd": rows("k_ytd", doubles="gross_pay_ytd net_pay_ytd employer_cost_ytd"),
    "d6e_payroll_trend": f"""SELECT strftime(pay_date, '%Y-%m') AS pay_period, CAST(sum(gross_pay) AS DOUBLE) AS period_gross_pay
FROM s_pay WHERE pay_date >= {AS_OF} - INTERVAL 6 MONTH GROUP BY 1 ORDER BY 1 DESC LIMIT 1""",
    "d7_headcount_metrics": rows("m_head", doubles="total_current_arrears total_arrears"),
    "d8_monthly_payroll_metrics": """SELECT corp_id, benefit_plan_type, benefit_plan_name, benefit_class_name,
  count(DISTINCT employee_id) AS employee_count, count(*) AS enrollment_records,
  CAST(sum(current_arrears) AS DOUBLE) AS total_current_arrears, CAST(sum(total_arrears) AS DOUBLE) AS total_arrears,
  count(*) FILTER (WHERE arrears_assigned) AS arrears_assigned_count,
  CAST(sum(num_pay_periods) AS BIGINT) AS total_pay_periods FROM s_ben GROUP BY 1, 2, 3, 4""",
    "d9_payroll_period_metrics": rows("m_period", doubles=_PERIOD_SUMS),
    "d10_shift_coverage_metrics": f"""SELECT shift, week_number, count(DISTINCT employee_id) AS staff_count,
  CAST(sum(record_count) AS BIGINT) AS total_records, CAST(sum(total_hours) AS DOUBLE) AS total_hours,
  CAST(sum(hours) AS DOUBLE) AS hours_worked,
  {rnd('CAST(sum(CAST(avg_rate AS DECIMAL(18,6))) AS DOUBLE) / count(avg_rate)', 2)} AS avg_rate,
  CAST(sum(shift_diff_hours) AS DOUBLE) AS shift_diff_hours,
  {pctn('sum(shift_diff_hours)', 'sum(hours)', 2)} AS shift_diff_pct FROM b_shift GROUP BY 1, 2""",
    "d11_workforce_metrics": rows(
        "m_wf", doubles="min_hourly_rate max_hourly_rate total_annual_payroll_estimate "
        "total_pto_balance total_sick_balance"),

    "e1_kpi_row": _KPI,
    "e2_attendance_trend": f"""SELECT CAST(attendance_date AS VARCHAR) AS attendance_date,
  CAST(sum(present_count) AS BIGINT) AS present, CAST(sum(absent_count) AS BIGINT) AS absent,
  {pctn('sum(present_count)', 'sum(total_records)')} AS rate
FROM m_daily WHERE attendance_date >= {AS_OF} - INTERVAL 30 DAY GROUP BY m_daily.attendance_date""",
    "e3_payroll_by_period": f"""SELECT pay_period, CAST(sum(total_gross_pay) AS DOUBLE) AS gross_pay,
  CAST(sum(total_employer_cost) AS DOUBLE) AS employer_cost, CAST(sum(employees_paid) AS BIGINT) AS employees
FROM m_period WHERE pay_period >= strftime({AS_OF} - INTERVAL 6 MONTH, '%Y-%m') GROUP BY 1""",
    "e4_top_alerts": _TOP_ALERTS,
    "e4b_alerts_shown": f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY priority ORDER BY alert_type, employee_name NULLS LAST, detail) AS rn
  FROM ({_TOP_ALERTS})) WHERE priority = 'High' OR rn <= 5""",
    "e5_basic_counts": f"""SELECT 'employees' AS measure, count(DISTINCT employee_id) AS cnt FROM s_ben
UNION ALL SELECT 'payroll_records', count(*) FROM {_BENEFITS}
UNION ALL SELECT 'attendance_records', count(*) FROM s_wk
UNION ALL SELECT 'activity_logs', count(*) FROM events""",
    "e6_workforce_summary": f"""SELECT count(DISTINCT employee_int_id) AS total_employees,
  count(DISTINCT CASE WHEN employee_status = 'Active' THEN employee_int_id END) AS active,
  count(DISTINCT department_name) AS departments, {rnd('avg(tenure_years)', 1)} AS avg_tenure FROM b_demo""",
    "e7_headcount_by_department": _count_by("department_name")
    + " ORDER BY count DESC, department_name NULLS LAST LIMIT 15",
    "e8_tenure_distribution": _count_by("tenure_band"),
    "e9_employee_types": _count_by("employee_type"),
    "e10_manager_spans": _count_by("manager_span"),
    "e11_workforce_departments": "SELECT DISTINCT department_name FROM b_demo WHERE department_name IS NOT NULL",
    "e13_attendance_summary": f"""SELECT CAST(sum(total_records) AS BIGINT) AS total_records,
  CAST(sum(present_count) AS BIGINT) AS present, CAST(sum(absent_count) AS BIGINT) AS absent,
  CAST(sum(late_count) AS BIGINT) AS late, {rnd('sum(CAST(ot_hours AS DECIMAL(18,2)))', 1)} AS ot_hours,
  {pctn('sum(present_count)', 'sum(total_records)')} AS attendance_rate FROM m_daily WHERE {_WINDOW}""",
    "e14_daily_presence": f"""SELECT CAST(m_daily.attendance_date AS VARCHAR) AS attendance_date,
  CAST(sum(present_count) AS BIGINT) AS present, CAST(sum(absent_count) AS BIGINT) AS absent
FROM m_daily WHERE {_WINDOW} GROUP BY m_daily.attendance_date""",
    "e15_departments_by_attendance": f"""SELECT department_name, CAST(sum(present_count) AS BIGINT) AS present,
  CAST(sum(absent_count) AS BIGINT) AS absent, {pctn('sum(present_count)', 'sum(total_records)')} AS rate
FROM m_daily WHERE {_WINDOW} AND department_name IS NOT NULL GROUP BY 1
ORDER BY rate DESC NULLS LAST, department_name LIMIT 10""",
    "e16_attendance_departments": "SELECT DISTINCT department_name FROM b_daily WHERE department_name IS NOT NULL",
    "e18_payroll_ytd_summary": f"""SELECT count(DISTINCT pay_period) AS periods,
  CAST(sum(total_gross_pay) AS DOUBLE) AS total_gross, CAST(sum(total_employer_cost) AS DOUBLE) AS total_cost,
  {avg2('avg_gross_pay', 2)} AS avg_pay, CAST(sum(employees_paid) AS BIGINT) AS total_paid
FROM m_period WHERE pay_year = 2001""",
    "e19_payroll_trend": _newest(_period_sums({"gross_pay": "total_gross_pay",
                                               "employer_cost": "total_employer_cost"}), 12),
    "e20_latest_period_departments": f"""SELECT department_name, CAST(total_gross_pay AS DOUBLE) AS total_gross_pay, employees_paid
FROM m_period WHERE pay_period = {_MAX_PERIOD.format('m_period')} AND department_name IS NOT NULL
ORDER BY m_period.total_gross_pay DESC, department_name, employees_paid LIMIT 10""",
    "e21_top_earners": f"""SELECT employee_name, department_name, CAST(gross_pay AS DOUBLE) AS gross_pay,
  CAST(total_hours AS DOUBLE) AS total_hours, effective_hourly_rate
FROM b_pay WHERE pay_period = {_MAX_PERIOD.format('b_pay')}
ORDER BY b_pay.gross_pay DESC, employee_name, department_name, b_pay.total_hours, effective_hourly_rate LIMIT 10""",
    "e22_deductions_and_taxes": _newest(_period_sums({
        "deductions": "total_deductions", "employee_taxes": "total_employee_taxes",
        "employer_taxes": "total_employer_taxes"}), 6),
    "e23_period_choices": _newest("SELECT DISTINCT pay_period FROM b_pay", 12),
    "e24_payroll_departments": "SELECT DISTINCT department_name FROM b_pay WHERE department_name IS NOT NULL",
    "e27_enrolment_by_plan_type": """SELECT benefit_plan_type, employee_count, enrollment_records,
  avg_current_arrears AS avg_arrears FROM m_head""",
    "e27_top_plan_types": """SELECT benefit_plan_type, employee_count, enrollment_records,
  avg_current_arrears AS avg_arrears FROM m_head
ORDER BY employee_count DESC, benefit_plan_type, enrollment_records, avg_arrears LIMIT 10""",
    "e27_plan_type_choices": "SELECT DISTINCT benefit_plan_type FROM m_head",
    "e29_recent_activity": """SELECT activity_id, activity_timestamp, module, activity_type, entered_by, system_ip
FROM s_log ORDER BY activity_timestamp DESC, activity_id LIMIT 100""",
    "e30_activity_by_module": """SELECT module, count(*) AS count FROM (
  SELECT module FROM s_log ORDER BY activity_timestamp DESC, activity_id LIMIT 100)
WHERE module IS NOT NULL GROUP BY 1""",

    "g1_longest_tenured": f"""SELECT full_name, department_name, job_code_name, tenure_years, estimated_annual_salary,
  CAST(gross_pay_ytd AS DOUBLE) AS ytd_gross_pay FROM (
  SELECT employee_int_id, full_name, department_name, job_code_name, tenure_years,
    CAST(estimated_annual_salary AS DOUBLE) AS estimated_annual_salary {_ACTIVE}
  ORDER BY tenure_years DESC NULLS LAST, full_name, department_name, job_code_name, b_demo.estimated_annual_salary, employee_int_id LIMIT 10)
LEFT JOIN (SELECT employee_int_id, gross_pay_ytd FROM s_pay QUALIFY row_number() OVER (
  PARTITION BY employee_int_id ORDER BY pay_date DESC NULLS LAST, payroll_work_id DESC NULLS LAST) = 1) USING (employee_int_id)""",
    "g2_department_payroll": f"""SELECT department_name, CAST(sum(active_employees) AS BIGINT) AS active_employees,
  {rnd('CAST(sum(CAST(avg_hourly_rate AS DECIMAL(18,6)) * 2080) AS DOUBLE) / count(avg_hourly_rate)', 0)} AS avg_salary,
  CAST(sum(total_annual_payroll_estimate) AS DOUBLE) AS total_payroll FROM m_wf GROUP BY 1""",
    "g3_monthly_payroll": f"""SELECT pay_period, employees, gross_pay, net_pay, hours, overtime_hours FROM (
  SELECT pay_period, CAST(sum(employees_paid) AS BIGINT) AS employees, CAST(sum(total_gross_pay) AS DOUBLE) AS gross_pay,
    CAST(sum(total_net_pay) AS DOUBLE) AS net_pay, CAST(sum(total_hours) AS DOUBLE) AS hours FROM m_period GROUP BY 1)
LEFT JOIN (SELECT strftime(attendance_date, '%Y-%m') AS pay_period, {rnd('CAST(sum(ot_duration) AS BIGINT) / 60.0', 2)} AS overtime_hours
  FROM s_att GROUP BY 1) USING (pay_period) ORDER BY 1 DESC LIMIT 12""",
    "g4_monthly_attendance": f"""SELECT r.*, employee_count FROM (
  SELECT strftime(attendance_date, '%Y-%m') AS year_month, department_name,
    CAST(sum(total_records) AS BIGINT) AS total_records,
    {pctn('sum(present_count)', 'sum(total_records)')} AS attendance_rate_pct,
    {pctn('sum(absent_count)', 'sum(total_records)')} AS absence_rate_pct,
    {pctn('sum(late_count)', 'sum(total_records)')} AS late_rate_pct
  FROM m_daily GROUP BY 1, 2 ORDER BY 1 DESC, 2 NULLS LAST LIMIT 10) r
LEFT JOIN (SELECT strftime(attendance_date, '%Y-%m') AS year_month, department_name, count(DISTINCT employee_int_id) AS employee_count
  FROM b_daily WHERE employee_int_id IS NOT NULL GROUP BY 1, 2) h
ON r.year_month = h.year_month AND r.department_name IS NOT DISTINCT FROM h.department_name""",
    "g5_top_salaries": f"""SELECT full_name, department_name, job_code_name,
  CAST(estimated_annual_salary AS DOUBLE) AS estimated_annual_salary {_ACTIVE}
ORDER BY b_demo.estimated_annual_salary DESC, full_name, department_name, job_code_name LIMIT 10""",
    "g6_salary_by_department": f"""SELECT department_name, count(*) AS employees,
  {rnd('CAST(sum(estimated_annual_salary) AS DOUBLE) / count(*)', 2)} AS avg_salary FROM b_demo GROUP BY 1""",
    "g6_headcount_from_metrics": f"""SELECT department_name, department_number, active_employees,
  {rnd('avg_hourly_rate', 2)} AS avg_hourly_rate FROM m_wf""",
    "g7_earnings_per_employee": """SELECT w.employee_int_id, full_name, department_name,
  CAST(total_earnings AS DOUBLE) AS total_earnings
FROM s_wf w LEFT JOIN (SELECT employee_int_id, sum(gross_pay) AS total_earnings FROM s_pay GROUP BY 1) p
ON w.employee_int_id = p.employee_int_id""",
    "g8_first_employees": rows("b_emp", doubles="total_current_arrears total_arrears",
                               tail="ORDER BY employee_id, employee_int_id, first_name, last_name LIMIT 10"),

    "h1_clinical_roles": "SELECT clinical_role, count(*) AS staff_count FROM h_staff GROUP BY 1",
    "h2_care_units": "SELECT care_unit_type, count(*) AS staff_count FROM h_staff GROUP BY 1",
    "h3_clinical_staff": "SELECT * FROM h_staff",
    "h4_shift_types": "SELECT shift_type, count(*) AS shifts FROM h_shift GROUP BY 1",
    "h5_day_types": "SELECT day_type, count(*) AS shifts FROM h_shift GROUP BY 1",
    "h6_shift_flags": """SELECT shift_type, day_type, is_extended_shift, has_differential, count(*) AS shifts
FROM h_shift GROUP BY 1, 2, 3, 4""",
    "h7_shift_coverage": rows("h_cover", texts="week_start_date"),
    "h7_monthly_coverage": f"""SELECT year_month, department, shift_type, {avg2('staff_count', 2)} AS avg_staff,
  {avg2('overtime_pct', 2)} AS avg_overtime_pct FROM h_cover GROUP BY 1, 2, 3""",
    "h7_high_overtime_weeks": f"""SELECT CAST(week_start_date AS VARCHAR) AS week_start_date, shift_type,
  {rnd('sum(CAST(total_overtime_hours AS DECIMAL(18,2)))', 2)} AS total_ot, {avg2('overtime_pct', 2)} AS avg_ot_pct
FROM h_cover GROUP BY h_cover.week_start_date, shift_type HAVING avg(overtime_pct) > 15""",
    "h8_clinical_workforce": "SELECT * FROM h_metrics",
    "h8_burnout_by_department": """SELECT department, clinical_role, care_unit_type, staff_count,
  high_burnout_risk_count, moderate_burnout_risk_count, burnout_risk_pct
FROM h_metrics WHERE employment_status = 'Active' AND burnout_risk_pct > 20""",
    "h8_new_hire_share": f"""SELECT clinical_role, care_unit_type, department, staff_count, new_hires_under_1_year,
  {pctn('new_hires_under_1_year', 'staff_count')} AS new_hire_pct
FROM h_metrics WHERE employment_status = 'Active'""",
    "h9_staffing_ratios": rows("h_ratio", texts="week_start_date"),
    "h9_icu_compliance": f"""SELECT CAST(week_start_date AS VARCHAR) AS week_start_date, department, shift_type,
  avg_rn_count, min_rn_count, days_below_min_rn_icu
FROM h_ratio WHERE department LIKE '%ICU%' AND h_ratio.week_start_date >= {AS_OF} - INTERVAL 28 DAY""",
    "h9_understaffed_shifts": """SELECT department, shift_type, CAST(week_start_date AS VARCHAR) AS week_start_date,
  avg_total_staff_count, min_total_staff_count, understaffed_days_pct
FROM h_ratio WHERE year = 2001 AND understaffed_days_pct > 10""",
    "h10_staff_distribution": f"""SELECT clinical_role, care_unit_type, count(*) AS staff_count,
  count(*) FILTER (WHERE employment_status = 'Active') AS active_count,
  {avg2('tenure_years', 1)} AS avg_tenure_years, {avg2('attendance_rate_pct', 1)} AS avg_attendance_rate
FROM h_staff GROUP BY 1, 2 ORDER BY staff_count DESC, clinical_role, care_unit_type LIMIT 15""",
    "h11_burnout_groups": _burnout_groups(50),
    "h11_burnout_groups_from_20_hours": _burnout_groups(20),
    "h12_coverage_by_week": f"""SELECT strftime(week_start_date, '%Y-%m-%d') AS week, shift_type,
  CAST(sum(staff_count) AS BIGINT) AS total_staff, {avg2('avg_hours_per_shift', 1)} AS avg_hours_per_shift,
  {rnd('sum(CAST(total_overtime_hours AS DECIMAL(18,2)))', 2)} AS total_overtime_hours,
  {avg2('overtime_pct', 1)} AS avg_overtime_pct, CAST(sum(extended_shifts_count) AS BIGINT) AS extended_shifts
FROM h_cover WHERE week_start_date >= {AS_OF} - INTERVAL 28 DAY GROUP BY week_start_date, shift_type""",
    "h13_staffing_this_month": """SELECT department, shift_type, CAST(week_start_date AS VARCHAR) AS week_start_date,
  CAST(round(CAST(avg_rn_count AS DECIMAL(18,2)), 1) AS DOUBLE) AS avg_rns,
  CAST(round(CAST(avg_lpn_count AS DECIMAL(18,2)), 1) AS DOUBLE) AS avg_lpns,
  CAST(round(CAST(avg_cna_count AS DECIMAL(18,2)), 1) AS DOUBLE) AS avg_cnas,
  CAST(round(CAST(avg_total_staff_count AS DECIMAL(18,2)), 1) AS DOUBLE) AS avg_total_staff,
  min_total_staff_count AS min_staff, max_total_staff_count AS max_staff,
  understaffed_days_pct AS pct_understaffed_days
FROM h_ratio WHERE year = 2001 AND month = 8""",
    "h14_critical_care_summary": """SELECT care_unit_type, clinical_role, department, staff_count, active_count,
  CAST(round(CAST(avg_tenure_years AS DECIMAL(18,2)), 1) AS DOUBLE) AS avg_tenure,
  CAST(round(CAST(avg_attendance_rate AS DECIMAL(18,2)), 1) AS DOUBLE) AS attendance_rate,
  high_burnout_risk_count, CAST(round(CAST(avg_overtime_pct AS DECIMAL(18,2)), 1) AS DOUBLE) AS avg_overtime_pct
FROM h_metrics WHERE employment_status = 'Active'
  AND care_unit_type IN ('ICU/Critical Care', 'Emergency Department', 'Surgical Services')""",
    "h15_differential_pay": f"""SELECT shift_type, day_type, CAST(sum(staff_count) AS BIGINT) AS total_staff,
  {rnd('sum(CAST(total_hours_worked AS DECIMAL(18,2)))', 2)} AS total_hours,
  CAST(sum(shifts_with_differential) AS BIGINT) AS differential_shifts,
  {avg2('differential_pct', 1)} AS avg_differential_pct {_COVER_MONTH.replace('07', '08')}""",
    "h16_turnover_indicators": f"""SELECT clinical_role, care_unit_type, department, staff_count,
  new_hires_under_1_year, experienced_staff_5plus_years,
  {pctn('new_hires_under_1_year', 'staff_count')} AS new_hire_pct,
  {pctn('experienced_staff_5plus_years', 'staff_count')} AS experienced_pct
FROM h_metrics WHERE employment_status = 'Active' AND staff_count >= 5
ORDER BY new_hire_pct DESC, clinical_role, care_unit_type, department NULLS LAST LIMIT 15""",
    "h17_icu_nurses_at_risk": """SELECT full_name, department, ytd_overtime_hours, burnout_risk_level FROM h_staff
WHERE clinical_role = 'Registered Nurse' AND care_unit_type = 'ICU/Critical Care'
  AND burnout_risk_level IN ('High Risk', 'Moderate Risk')""",
    "h17_active_staff_by_role": """SELECT clinical_role, care_unit_type, count(*) AS staff_count
FROM h_staff WHERE employment_status = 'Active' GROUP BY 1, 2""",
    "h18_night_shift_staffing": f"""SELECT CAST(h_shift.attendance_date AS VARCHAR) AS attendance_date, department,
  count(*) AS staff_count, {rnd('CAST(sum(worked_minutes) AS BIGINT) / 60.0', 2)} AS total_hours,
  {rnd('CAST(sum(overtime_minutes) AS BIGINT) / 60.0', 2)} AS total_overtime
FROM h_shift WHERE shift_type = 'Night Shift' AND h_shift.attendance_date >= {AS_OF} - 7
GROUP BY h_shift.attendance_date, department""",
    "h18_weekend_coverage": f"""SELECT department, count(DISTINCT employee_id) AS unique_staff
FROM h_shift WHERE day_type = 'Weekend' AND attendance_date >= {AS_OF} - 30 GROUP BY 1""",
    "h19_rn_shortfalls": rows("h_ratio", texts="week_start_date",
                              tail="WHERE care_unit_type = 'ICU/Critical Care' AND min_rn_count < 2"),
    "h20_differential_hours": f"""SELECT shift_type, day_type,
  {rnd('sum(shifts_with_differential * CAST(avg_hours_per_shift AS DECIMAL(18,2)))', 2)} AS differential_hours
{_COVER_MONTH}""",
    "h21_retention_risks": """SELECT employee_int_id, full_name, department, clinical_role, ytd_overtime_hours,
  burnout_risk_level, attendance_rate_pct FROM h_staff
WHERE burnout_risk_level = 'High Risk' OR attendance_rate_pct < 90""",
    "h22_variable_shifts": """SELECT department, shift_type, CAST(week_start_date AS VARCHAR) AS week_start_date,
  staff_count_stddev, min_total_staff_count, max_total_staff_count
FROM h_ratio WHERE staff_count_stddev > 2""",
}

_DETAIL = """SELECT employee_id, full_name, department_name, job_code_name, employee_type, employee_status,
  tenure_band, tenure_years, direct_reports, CAST(hourly_rate AS DOUBLE) AS hourly_rate FROM b_demo {}
ORDER BY department_name, full_name, employee_id, job_code_name, tenure_years, b_demo.hourly_rate LIMIT 500"""
_RECORDS = f"""SELECT CAST(b_daily.attendance_date AS VARCHAR) AS attendance_date, employee_name, department_name,
  attendance_status, is_late, late_by_mins, total_hours, ot_hours FROM b_daily
WHERE b_daily.{_WINDOW} {{}} ORDER BY b_daily.attendance_date DESC, employee_name, department_name,
  attendance_status, is_late, late_by_mins, total_hours, ot_hours LIMIT 500"""
_PAY = """SELECT employee_name, department_name, pay_period, CAST(gross_pay AS DOUBLE) AS gross_pay,
  CAST(net_pay AS DOUBLE) AS net_pay, CAST(deductions AS DOUBLE) AS deductions,
  CAST(total_hours AS DOUBLE) AS total_hours, effective_hourly_rate FROM b_pay {}
ORDER BY b_pay.gross_pay DESC, employee_name, department_name, pay_period, b_pay.net_pay, b_pay.deductions,
  b_pay.total_hours, effective_hourly_rate LIMIT 500"""
_SEARCH = """SELECT employee_id, full_name, num_benefit_plans, benefit_plan_types,
  CAST(total_current_arrears AS DOUBLE) AS total_current_arrears, corp_id FROM b_emp {}
ORDER BY full_name, employee_id, b_emp.total_current_arrears LIMIT 100"""
_BENEFIT = """SELECT employee_id, first_name || ' ' || last_name AS full_name, benefit_plan_type, benefit_plan_name,
  coverage_tier, CAST(current_arrears AS DOUBLE) AS current_arrears, CAST(total_arrears AS DOUBLE) AS total_arrears
FROM s_ben {} ORDER BY last_name, first_name, benefit_plan_type, benefit_plan_name, coverage_tier, employee_id,
  s_ben.current_arrears, s_ben.total_arrears LIMIT 500"""

_QUERIES.update({
    "e12_employee_details": _DETAIL.format(""),
    "e12_employee_details_filtered": _DETAIL.format(
        "WHERE department_name = 'ICU NATION_0' AND employee_status = 'Active' AND tenure_band = '10-19 Years'"),
    "e17_attendance_records": _RECORDS.format(""),
    "e17_attendance_records_filtered": _RECORDS.format(
        "AND department_name = 'ICU NATION_0' AND attendance_status = 'Present' AND is_late"),
    "e25_payroll_records": _PAY.format(""),
    "e25_payroll_records_filtered": _PAY.format(
        "WHERE pay_period = '2001-07' AND department_name = 'ICU NATION_0'"),
    "e26_employee_search": _SEARCH.format(
        "WHERE lower(full_name) LIKE lower('%aDa 1_%') OR employee_id LIKE '%aDa 1_%'"),
    "e26_employee_list": _SEARCH.format(""),
    "e28_benefits_detail": _BENEFIT.format(""),
    "e28_benefits_detail_filtered": _BENEFIT.format("WHERE benefit_plan_type = 'ECONOMY'"),
})


# Whole numbers and flags that hold nulls, compared as text.
_HOLD_NULLS: dict[str, str] = {
    "a1_import_table": "Activity_Id", "a1_import_window": "Activity_Id", "a2_recent_window": "Activity_Id", "a2_window_history": "Activity_Id",
    "a3_clean_columns": "arrears_assigned_yn Age",
    "b2_stg_attendance": "shift_diff_flag",
    "b3_stg_daily_attendance": "attendance_id attendance_status_id employee_int_id",
    "b6_stg_payroll": "age arrears_assigned", "b6_stg_payroll_from_text": "age arrears_assigned", "s12_accepted_rows": "age arrears_assigned", "b7_stg_payroll_main": "payroll_work_id",
    "c1_attendance_detail": "shift_diff_flag", "c2_daily_attendance_detail": "attendance_id employee_int_id",
    "c2_daily_attendance_bucketed": "attendance_id employee_int_id", "c2_daily_attendance_split": "attendance_id employee_int_id",
    "c4_payroll_analytics": "payroll_work_id", "c5_payroll_detail": "age arrears_assigned",
    "c8_workforce_demographics": "age tenure_years", "e12_employee_details": "tenure_years",
    "e12_employee_details_filtered": "tenure_years", "h3_clinical_staff": "tenure_years",
}


def _with_nulls_cast(name: str, query: str) -> str:
    casts = _HOLD_NULLS.get(name)
    if not casts:
        return query
    replaced = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in casts.split())
    return f"SELECT * REPLACE ({replaced}) FROM ({query})"


# Queries that have a twin over one master row per employee.
LATEST_TWINS = ("c2_daily_attendance_detail", "c4_payroll_analytics", "d1_attendance_daily_metrics",
                "d5b_chronic_lateness", "d5c_department_absence", "d5d_excessive_overtime",
                "d9_payroll_period_metrics", "e16_attendance_departments", "e24_payroll_departments")


def statements() -> dict[str, str]:
    found = {name: with_tables(_with_nulls_cast(name, query)) for name, query in _QUERIES.items()}
    return found | {f"{name}_latest": with_tables(_with_nulls_cast(name, _QUERIES[name]), LATEST)
                    for name in LATEST_TWINS}
