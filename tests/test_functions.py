import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rosterloom.functions import (
    as_integer, ascending, contains_pattern, day_name, day_of_week, descending, distinct_count,
    exact_mean, full_name, guarded_ratio, hours, iso_week, months_before, nullable_ratio,
    parse_date, round_to, trimmed, years_between,
)


def one(spark, column, **values):
    """The value of ``column`` over a one-row frame of literals."""
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(column.alias("value")).first()["value"]


def test_days_of_the_week_count_from_sunday(spark):
    days = [dt.date(2024, 6, 2) + dt.timedelta(days=i) for i in range(7)]
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    rows = frame.select(day_of_week("d").alias("n"), day_name("d").alias("name")).collect()
    assert [r.n for r in rows] == [0, 1, 2, 3, 4, 5, 6]
    assert [r.name for r in rows] == ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday",
                                      "Friday", "Saturday"]


def test_iso_week_of_year_end(spark):
    assert one(spark, iso_week("d"), d=dt.date(2024, 12, 30)) == 1
    assert one(spark, iso_week("d"), d=dt.date(2021, 1, 1)) == 53


def test_years_are_calendar_boundaries(spark):
    assert one(spark, years_between("d", dt.date(2021, 1, 1)), d=dt.date(2020, 12, 31)) == 1
    assert one(spark, years_between("d", dt.date(2021, 12, 31)), d=dt.date(2021, 1, 1)) == 0


@pytest.mark.parametrize("day, months, expected", [
    (dt.date(2024, 8, 31), 6, dt.date(2024, 2, 29)),
    (dt.date(2024, 1, 15), 6, dt.date(2023, 7, 15)),
    (dt.date(2024, 3, 31), 1, dt.date(2024, 2, 29)),
    (dt.date(2023, 12, 31), -1, dt.date(2024, 1, 31)),
    (dt.date(2024, 11, 30), -1, dt.date(2024, 12, 30)),
])
def test_months_before(spark, day, months, expected):
    assert months_before(day, months) == expected
    assert one(spark, F.add_months("d", -months), d=day) in (expected, expected)


@pytest.mark.parametrize("text, expected", [
    ("2021-01-02", dt.date(2021, 1, 2)), ("2021/01/02", dt.date(2021, 1, 2)),
    ("2021-1-2", dt.date(2021, 1, 2)), (" 2021-01-02 ", dt.date(2021, 1, 2)),
    ("2021 01 02", dt.date(2021, 1, 2)), ("2021-01-02 10:00:00", dt.date(2021, 1, 2)),
    ("2021-01-02T10:00:00", dt.date(2021, 1, 2)), ("2021", None), ("2021-01", None),
    ("01/02/2021", None), ("2021-02-30", None), ("2021-01/02", None), ("20210102", None),
    ("2021-01-02 garbage", None), ("unknown", None), ("", None), (None, None),
])
def test_parse_date(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(parse_date(F.col("t"))).first()[0] == expected


def test_parse_date_agrees_with_the_other_engine(spark):
    import duckdb
    texts = ["2021-01-02", "2021/1/2", "2021\\01\\02", "2021 1 2", "2021-13-01", "2021/02/30",
             "99-01-01x", "2021-01-02 10:00", "2021-01-02x", "  2021/12/31", "2021-01"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    ours = {r[0]: r[1] for r in frame.select("t", parse_date(F.col("t"))).collect()}
    for text in texts:
        theirs = duckdb.execute("SELECT TRY_CAST(? AS DATE)", [text]).fetchall()[0][0]
        assert ours[text] == theirs, text


@pytest.mark.parametrize("value, expected", [
    (Decimal("2.5"), 3), (Decimal("-2.5"), -3), (2.5, 2), (3.5, 4), (-2.5, -2), ("7.6", 8),
    ("-7.5", -8), (7, 7),
])
def test_integer_casts_round(spark, value, expected):
    frame = spark.range(1).select(F.lit(value).alias("v"))
    assert frame.select(as_integer(F.col("v"), frame.schema["v"].dataType)).first()[0] == expected


def test_rounding_is_half_away_from_zero(spark):
    assert one(spark, round_to(F.col("x"), 2), x=1.005) == 1.01
    assert one(spark, round_to(F.col("x"), 1), x=-0.25) == -0.3
    assert one(spark, hours(F.col("m")), m=50) == 0.83


def test_ratios_tell_zero_from_null(spark):
    a, b = F.col("a"), F.col("b")
    assert one(spark, guarded_ratio(a, b, 1, 100.0), a=1, b=3) == 33.3
    assert one(spark, guarded_ratio(a, b, 1, 100.0), a=1, b=0) == 0.0
    assert one(spark, nullable_ratio(a, b, 1, 100.0), a=1, b=0) is None


def test_nulls_sort_last_both_ways(spark):
    frame = spark.createDataFrame([(2,), (None,), (1,)], "x int")
    assert [r.x for r in frame.orderBy(*ascending("x")).collect()] == [1, 2, None]
    assert [r.x for r in frame.orderBy(*descending("x")).collect()] == [2, 1, None]


def test_trim_keeps_tabs_and_names_propagate_null(spark):
    frame = spark.createDataFrame([(" \ta ", None)], "`a b` string, c string")
    assert frame.select(trimmed("a b")).first()[0] == "\ta"
    assert frame.select(full_name(trimmed("a b"), "c")).first()[0] is None


def test_search_pattern_escapes_backslash_only(spark):
    frame = spark.createDataFrame([("a\\b",), ("axb",), ("a%b",)], "t string")

    def found(text):
        return [r.t for r in frame.where(F.col("t").like(contains_pattern(text))).collect()]

    assert found("\\") == ["a\\b"]
    assert found("a_b") == ["a\\b", "axb", "a%b"]
    assert found("%") == ["a\\b", "axb", "a%b"]


def test_conditional_distinct_count_equals_case_form(spark):
    frame = spark.createDataFrame(
        [("x", 1, True), ("x", 1, False), ("x", 2, None), ("x", None, True), ("y", 3, False)],
        "g string, id int, flag boolean")
    ours = frame.groupBy("g").agg(distinct_count("id").alias("n"),
                                  distinct_count("id", "flag").alias("k"))
    plain = frame.groupBy("g").agg(F.count_distinct("id").alias("n"),
                                   F.count_distinct(F.when(F.col("flag"), F.col("id"))).alias("k"))
    assert sorted(ours.collect()) == sorted(plain.collect()) == [("x", 2, 1), ("y", 1, 0)]


def test_mean_of_nothing_is_null(spark):
    frame = spark.createDataFrame([(None,)], "x decimal(8,2)")
    assert frame.agg(exact_mean("x")).first()[0] is None
