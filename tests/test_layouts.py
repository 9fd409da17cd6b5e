"""The master join over bucketed tables, and with frequent employees split: plans, even tasks, equal rows."""

import re
from collections import Counter

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from rosterloom.operators import join_bucketed, join_split, join_workforce
from rosterloom.operators.workforce import heavy_employees
from rosterloom.registry import _bucketed, model_of, split_detail
from rosterloom.sources import ingest


@pytest.fixture
def without(spark):
    """Settings for one test."""
    changed = {}

    def change(**settings):
        for name, value in settings.items():
            name = name.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)
    yield change
    for name, value in changed.items():
        spark.conf.set(name, value)


def rows(frame):
    return Counter(map(tuple, frame.select(*sorted(frame.columns)).collect()))


def test_bucketed_tables_join_without_a_shuffle(spark, without):
    without(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    punches, people = _bucketed(spark, SMALL)
    joined = join_bucketed(punches, people)
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text
    plain = join_workforce(punches, people, ["attendance_id", "attendance_date"])
    assert rows(joined.select("attendance_id", "department_name", "copies")) == rows(
        plain.select("attendance_id", "department_name", "copies"))


def test_layouts_that_exclude_each_other():
    for wrong in ({"bucket_by": ("a",)}, {"buckets": 3}, {"bucket_by": ("a",), "buckets": 3, "cluster_by": ("b",)}):
        with pytest.raises(ValueError):
            ingest.TableLayout(**wrong)


@pytest.fixture(scope="module")
def skewed(spark):
    """Half the facts are one employee's, some are nobody's."""
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 31 == 0, F.lit(None)).otherwise(F.col("id") % 500)
    facts = spark.range(20_000).select(F.col("id").alias("attendance_id"), key.cast("long").alias("employee_int_id"))
    people = spark.range(400).select(F.col("id").alias("employee_int_id"), (F.col("id") % 9).alias("department_name"),
                                     F.lit(2).cast("long").alias("copies"))
    return facts, people.unionByName(spark.createDataFrame([(7, 100, 5)], people.schema))


def test_a_frequent_employee_is_split_without_aqe(spark, skewed, without):
    without(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="16")
    facts, people = skewed
    split = join_split(facts, people, ["attendance_id"], most=500)
    assert rows(split) == rows(join_workforce(facts, people, ["attendance_id"]))

    def largest(frame):
        sizes = [r[0] for r in frame.groupBy(F.spark_partition_id()).count().select("count").collect()]
        return max(sizes) / (sum(sizes) / 16)
    assert largest(join_workforce(facts, people, ["attendance_id"])) > 6
    assert largest(split) < 2.5


def test_heavy_employees_are_few(skewed):
    facts, _ = skewed
    assert [tuple(r) for r in heavy_employees(facts, 500).collect()] == [(7, 21)]
    assert heavy_employees(facts.limit(0), 1).collect() == []


def test_the_detail_view_is_the_same_however_it_is_split(spark):
    model = model_of(spark, SMALL)
    assert rows(split_detail(model, most=3).drop("entered_date")) == rows(model.daily_attendance_detail().drop("entered_date"))


def test_buckets_grow_with_the_lines_and_hold_what_the_view_shows(spark, monkeypatch):
    monkeypatch.setattr("rosterloom.registry.BUCKET_ROWS", 100)
    punches, people = _bucketed(spark, SMALL)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    files = {f.rpartition("_")[2] for f in punches.inputFiles()}
    assert 16 < len(files) <= -(-lines // 100)
    assert "source_table" not in punches.columns and "_loaded_at" not in punches.columns


def test_facts_are_not_shuffled_to_find_frequent_employees(spark, skewed, without):
    without(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    text = join_split(*skewed, ["attendance_id"], most=500)._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") == 2 and text.count("SortMergeJoin") == 1
