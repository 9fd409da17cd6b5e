"""A local session, and raw frames from a few hand-written rows."""

from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rosterloom.plans import staging  # noqa: E402
from rosterloom.session import build_session  # noqa: E402
from rosterloom.sources.schemas import raw_schema  # noqa: E402

AS_OF = dt.date(2024, 6, 30)
LOADED_AT = dt.datetime(2024, 7, 1)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests", "local[4]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g", spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(warehouse),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _typed(value, field):
    if value is None or field.dataType.typeName() != "decimal":
        return value
    return Decimal(str(value))


def raw_frame(spark, table, rows):
    """Rows given as dicts; columns not named are null."""
    schema = raw_schema(table)
    unknown = {key for row in rows for key in row} - set(schema.fieldNames())
    assert not unknown, unknown
    return spark.createDataFrame(
        [tuple(_typed(row.get(f.name), f) for f in schema.fields) for row in rows], schema)


class Maker:
    """Staged frames from hand-written raw rows."""

    def __init__(self, spark):
        self.spark = spark

    def raw(self, table, rows):
        return raw_frame(self.spark, table, rows)

    def workforce(self, rows):
        """Rows as (int id, overrides)."""
        full = [{"emp_int_id": key, "EmployeeId": f"E{key}", "First Name": "F",
                 "Last Name": str(key), "EmployeeStatus": "Active", "DepartmentName": "ICU",
                 "DepartmentNumber": "D1", "tcpaydt_int_id": 1, **extra} for key, extra in rows]
        return staging.stg_workforce(self.raw("workforcetable_rpt", full), LOADED_AT)

    def daily(self, rows):
        """Rows as (attendance id, employee, date, overrides)."""
        full = [{"Att_Int_Id": key, "Emp_Int_Id": person, "Att_For_Date": day,
                 "Att_Status_Id": 1, **extra} for key, person, day, extra in rows]
        return staging.stg_daily_attendance(self.raw("thr_attendance", full), LOADED_AT)

    def pay(self, rows):
        """Rows as (pay id, employee, date, overrides)."""
        full = [{"tcpaywrk_int_id": key, "emp_int_id": person, "pay_dt": day, **extra}
                for key, person, day, extra in rows]
        return staging.stg_payroll_main(self.raw("tpp_tc_main", full), LOADED_AT)

    def benefits(self, rows):
        return staging.stg_payroll(self.raw("crmc_payrollfile", rows), LOADED_AT)

    def weekly(self, rows):
        return staging.stg_attendance(
            {"attendance_031820": self.raw("attendance_031820", rows)}, LOADED_AT)


@pytest.fixture
def make(spark):
    return Maker(spark)


def dicts(frame, *order):
    rows = [row.asDict(recursive=True) for row in frame.collect()]
    key = lambda row: tuple((row[name] is None, str(row[name])) for name in order)
    return sorted(rows, key=key) if order else rows
