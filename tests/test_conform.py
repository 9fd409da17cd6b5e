from decimal import Decimal

import pytest
from conftest import LOADED_AT, dicts
from pyspark.sql import functions as F

from rosterloom.plans import staging
from rosterloom.sources import conform as feeds
from rosterloom.sources.conform import conform, uncastable
from rosterloom.sources.schemas import raw_schema
from rosterloom.sources.scratch import fresh_database


@pytest.fixture
def schema(spark):
    return raw_schema("crmc_payrollfile")


def feed(spark, **columns):
    """One benefits line, all columns as text."""
    values = {f.name: None for f in raw_schema("crmc_payrollfile").fields} | {"Employee ID": "E1"} | columns
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"`{n}` string" for n in values))


def test_good_text_is_cast_and_staged(spark, schema):
    raw = feed(spark, **{"Age": "41", "No of PP": "2.5", "Current Arrears": " 12.345 ", "arrears_assigned_yn": "true", "Corp_Id": ""})
    for on_bad in ("raise", "null"):
        row = dicts(staging.stg_payroll(conform(raw, schema, on_bad), LOADED_AT))[0]
        assert (row["age"], row["num_pay_periods"], row["current_arrears"], row["arrears_assigned"], row["corp_id"]) == (
            41, 3, Decimal("12.35"), True, None)


def test_bad_text_stops_or_becomes_null(spark, schema):
    raw = feed(spark, **{"Age": "n/a", "Current Arrears": "12,5", "arrears_assigned_yn": "maybe", "Corp_Id": "7"})
    row = dicts(staging.stg_payroll(conform(raw, schema, "null"), LOADED_AT))[0]
    assert (row["age"], row["current_arrears"], row["arrears_assigned"], row["corp_id"]) == (None, None, None, 7)
    with pytest.raises(Exception, match="cannot cast"):
        conform(raw, schema, "raise").collect()
    with pytest.raises(ValueError):
        conform(raw, schema, "ignore")


def test_bad_values_are_counted(spark, schema):
    raw = feed(spark, **{"Age": "n/a", "Corp_Id": "7"}).unionByName(feed(spark, **{"Age": "", "Corp_Id": "x"}))
    counts = {r["check_name"]: (r["passed"], r["details"]) for r in dicts(uncastable(raw, "t", schema))}
    assert counts["castable:Age"] == (False, "1 bad values") and counts["castable:Corp_Id"] == (False, "1 bad values")
    assert counts["castable:Total Arrears"] == (True, "0 bad values")
    assert "castable:First Name" not in counts


def test_quarantine_splits_a_feed_that_adds_up(spark, schema):
    """Rejected rows come back as delivered; corrected and fed again, all are accepted."""
    rows = [{"Age": "41"}, {"Age": "n/a", "Corp_Id": "x", "Total Arrears": " 3.10 "}, {"Age": " "}, {"Corp_Id": "7"},
            {"arrears_assigned_yn": "maybe"}, {"arrears_assigned_yn": "maybe"}]
    raw = None
    for row in rows:
        raw = feed(spark, **row) if raw is None else raw.unionByName(feed(spark, **row))
    target = f"{fresh_database(spark, 'quarantine')}.feed"
    assert feeds.quarantine(raw, target, schema) == (3, 3)
    good, bad = feeds.accepted(spark, target), feeds.rejected(spark, target)
    assert good.columns == raw.columns and bad.columns == [*raw.columns, "_failed"]
    assert sorted(r["Age"] or 0 for r in dicts(good)) == [0, 0, 41]
    failed = {tuple(sorted(r["_failed"])) for r in dicts(bad)}
    assert failed == {("Age", "Corp_Id"), ("arrears_assigned_yn",)}
    wrong = raw.where("Age = 'n/a' OR arrears_assigned_yn = 'maybe'")
    assert bad.drop("_failed").exceptAll(wrong).count() == 0 and wrong.exceptAll(bad.drop("_failed")).count() == 0
    mended = bad.drop("_failed").replace("n/a", "42", "Age").replace("x", "8", "Corp_Id").withColumn(
        "arrears_assigned_yn", F.when(F.col("arrears_assigned_yn") != "maybe", F.col("arrears_assigned_yn")))
    assert feeds.quarantine(mended, f"{target}_mended", schema) == (3, 0)
    assert feeds.quarantine(raw.limit(0), f"{target}_none", schema) == (0, 0)
    assert feeds.quarantine(good, f"{target}_typed", schema) == (3, 0)


def test_accepted_rows_read_no_rejected_files(spark, schema):
    raw = feed(spark, Age="n/a").unionByName(feed(spark, Age="3"))
    target = f"{fresh_database(spark, 'quarantine_files')}.feed"
    feeds.quarantine(raw, target, schema)
    assert all("_accepted=true" in name for name in feeds.accepted(spark, target).inputFiles())


def test_quarantine_neither_sorts_the_feed_nor_lists_texts_of_sound_rows(spark, monkeypatch):
    """Lists and maps lie under a condition; two open files a task instead of a sort by folder."""
    from rosterloom.sources import conform, ingest
    seen, key = [], "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)

    def watched(frame, target, layout):
        seen.append((spark.conf.get(key), frame._jdf.queryExecution().optimizedPlan().toString()))
        return ingest.replace_table(frame, target, layout)
    monkeypatch.setattr(conform, "replace_table", watched)
    feed = spark.createDataFrame([("1", "x"), ("2.5", "y"), ("?", "z"), (" ", None)], "n string, t string")
    spark.sql("CREATE DATABASE IF NOT EXISTS quarantine_plan")
    schema = spark.createDataFrame([], "n int, t string").schema
    assert conform.quarantine(feed, "quarantine_plan.feed", schema) == (3, 1)
    (writers, text), = seen
    assert writers == "2" and spark.conf.get(key) == before
    assert text.count("map(n,") == text.count("THEN map(n,") + text.count("THEN cast(map(n,") > 0
    assert sorted(map(tuple, conform.accepted(spark, "quarantine_plan.feed").collect()), key=str) == [(1, "x"), (3, "y"), (None, None)]
