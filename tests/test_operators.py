import datetime as dt
import random
from collections import Counter

from conftest import dicts
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rosterloom import operators


def test_copies_are_expanded_across_blocks(spark):
    sizes = {1: 1, 2: 2, 3: 4096, 4: 4097, 5: 9000}
    frame = spark.createDataFrame(list(sizes.items()), "id int, copies long")
    counted = operators.expand_copies(frame).groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in counted} == sizes


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(facts=st.lists(st.sampled_from([None, 1, 1, 1, 2, 3]), max_size=12),
       people=st.lists(st.tuples(st.sampled_from([None, 1, 1, 2, 4]),
                                 st.sampled_from([None, "a", "b"])), max_size=12))
def test_weighted_join_is_the_plain_left_join(spark, facts, people):
    fact = spark.createDataFrame(list(enumerate(facts)), "fact int, employee_int_id long")
    master = spark.createDataFrame(people, "employee_int_id long, department string")
    joined = operators.join_workforce(
        fact, operators.workforce_dimension(master, ["department"]))
    plain = fact.join(master, "employee_int_id", "left")
    expanded = operators.expand_copies(joined).select("fact", "department")
    assert Counter(map(tuple, expanded.collect())) == Counter(
        map(tuple, plain.select("fact", "department").collect()))
    weighted = joined.groupBy("department").agg(operators.weighted_sum("fact").alias("s"))
    assert Counter(map(tuple, weighted.collect())) == Counter(
        map(tuple, plain.groupBy("department").agg(F.sum("fact")).collect()))


def test_a_hot_employee_on_both_sides(spark):
    """One employee holds a third of the facts and of the snapshots."""
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("employee_int_id"))
    master = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("employee_int_id"),
        (F.col("id") % 2).alias("department"))
    joined = operators.join_workforce(
        fact, operators.workforce_dimension(master, ["department"]))
    assert joined.count() < 5100
    total = joined.agg(F.sum("copies")).first()[0]
    assert total == fact.join(master, "employee_int_id", "left").count()
    assert operators.expand_copies(joined).count() == total


def test_facts_without_an_employee_are_dealt_out(spark):
    """Half of the facts have no employee: no task gets more than its share of them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(8000).selectExpr("id AS fact", "IF(id % 2 = 0, NULL, id) AS employee_int_id")
        people = spark.range(8000).selectExpr("id AS employee_int_id", "'a' AS department")
        joined = operators.join_workforce(
            fact, operators.workforce_dimension(people, ["department"]), ["fact"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 8000 and max(sizes) < 1.5 * 8000 / len(sizes)
        assert joined.where("department IS NOT NULL").count() == 4000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_k_of_many_is_top_k(spark):
    frame = spark.range(1000).selectExpr("id * 7919 % 1009 AS x").repartition(13)
    found = operators.top_k_of_many(frame, [F.desc("x")], 25, groups=4).collect()
    assert [r["x"] for r in found] == [r["x"] for r in operators.top_k(frame, [F.desc("x")], 25).collect()]


def test_latest_snapshot_wins_and_ties_are_settled(spark):
    rows = [(1, 5, "old"), (1, 9, "new"), (2, None, "only"), (3, 4, "a"), (3, 4, "b"),
            (None, 1, "nobody")]
    frame = spark.createDataFrame(
        rows, "employee_int_id long, tcpaydt_int_id long, department string")
    found = {r["employee_int_id"]: r["department"]
             for r in dicts(operators.latest_workforce(frame, ["department"]))}
    assert found == {1: "new", 2: "only", 3: "b"}


def test_latest_snapshot_is_the_maximum_of_id_and_attributes(spark):
    random.seed(2)
    pick = lambda *values: random.choice([None, *values])
    rows = [(random.randrange(40), pick(1, 2, 3), pick("x", "y", ""), pick(0.5, float("nan")), pick(dt.date(2024, 1, 1)))
            for _ in range(600)] + [(7, 3, "y", 0.5, None)] * 200
    frame = spark.createDataFrame(
        rows, "employee_int_id long, tcpaydt_int_id long, department string, rate double, hired date").repartition(7)
    kept = ["department", "rate", "hired"]
    greatest = frame.groupBy("employee_int_id").agg(F.max(F.struct("tcpaydt_int_id", *kept)).alias("m")).select(
        "employee_int_id", *(f"m.{c}" for c in kept))
    found = operators.latest_workforce(frame, kept)
    assert found.count() == 40 and found.exceptAll(greatest).count() == 0


def test_top_k_per_group(spark):
    random.seed(1)
    rows = [("hot", random.random()) for _ in range(500)] + [("cold", 0.5), ("cold", 0.1)]
    frame = spark.createDataFrame(rows, "g string, x double")
    found = operators.top_k_per_group(frame, ["g"], [F.col("x").desc()], 3)
    best = sorted((x for g, x in rows if g == "hot"), reverse=True)[:3]
    assert sorted(map(tuple, found.collect())) == sorted(
        [("hot", x) for x in best] + [("cold", 0.5), ("cold", 0.1)])


def test_optional_filters(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    assert operators.keep(frame, operators.equals_where_given(x=None, y=None)).count() == 2
    assert operators.keep(frame, operators.equals_where_given(x=1, y="b")).count() == 0
    quote = operators.equals_where_given(y="a' OR '1'='1")
    assert operators.keep(frame, quote).count() == 0


def test_adaptive_execution_splits_a_hot_employees_facts(spark):
    """No single task of the detail join gets all rows of the hot employee."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
               "spark.sql.adaptive.coalescePartitions.enabled": "false",
               "spark.sql.shuffle.partitions": "16"}
    before = {key: spark.conf.get(key, None) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        facts = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("employee_int_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        master = spark.range(60_000).select(F.col("id").alias("employee_int_id"),
                                            (F.col("id") % 5).alias("department"))
        joined = operators.expand_copies(operators.join_workforce(
            facts, operators.workforce_dimension(master, ["department"])))
        per_task = joined.groupBy(F.spark_partition_id()).agg(
            F.count(F.lit(1)).alias("n"), F.max("payload"), F.max("department"))
        sizes = [r["n"] for r in per_task.collect()]
        assert sum(sizes) == 60_000 and max(sizes) < 10_000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
