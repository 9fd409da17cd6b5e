import datetime as dt

import pytest
from conftest import AS_OF, LOADED_AT, SMALL, dicts
from pyspark.sql import functions as F

from rosterloom.model import VIEWS, WorkforceModel
from rosterloom.sources import ingest, materialize, quality
from rosterloom.sources.scratch import fresh_database, shared_folder
from rosterloom.sources.starschema import AS_OF as STAR_AS_OF, StarSchemaTables

NOW = dt.datetime(2024, 1, 31)


@pytest.mark.parametrize("source, target", [
    ("Activity_Log", "activity_log"), ("Payroll File 03012021", "payroll_file_03012021"),
    ("2024 people", "t_2024_people"), ("'Sheet1$'", "sheet1"), ("a-b'c$", "a_bc"),
    ("", "")])
def test_target_names(source, target):
    assert ingest.target_name(source) == target


def test_column_names_are_cleaned(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "`a b` int, `c$#d` int, plain int")
    assert ingest.clean_column_names(frame).columns == ["a_b", "cd", "plain"]


@pytest.fixture
def database(spark):
    return fresh_database(spark, "tests")


def test_shared_folder_is_the_clusters(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_fresh_database_drops_what_was_there(spark):
    name = fresh_database(spark, "reused")
    ingest.replace_table(spark.range(3), f"{name}.t")
    assert fresh_database(spark, "reused") == name
    assert not spark.catalog.tableExists(f"{name}.t")


def test_a_failed_replacement_leaves_the_old_table(spark, database):
    ingest.replace_table(spark.range(3), f"{database}.kept")
    with pytest.raises(Exception):
        ingest.replace_table(spark.range(2).select(F.raise_error(F.lit("boom")).alias("id")), f"{database}.kept")
    assert spark.table(f"{database}.kept").count() == 3
    assert not spark.catalog.tableExists(f"{database}.kept__new")


def test_import_replaces_and_logs(spark, database):
    log = f"{database}.import_log"

    def run(rows):
        job = ingest.ImportJob("My Table", lambda: spark.range(rows))
        return ingest.import_table(spark, job, database=database, log_table=log, now=NOW)

    assert run(5) == 5 and run(3) == 3
    assert spark.table(f"{database}.my_table").count() == 3
    assert [(r["row_count"], r["status"]) for r in dicts(spark.table(log), "row_count")] == [
        (3, "success"), (5, "success")]


def test_layouts_keep_the_rows_and_cluster_the_files(spark, database):
    rows = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("day"),
                                    (F.col("id") % 2).alias("side"))
    layout = ingest.TableLayout(cluster_by=("day", "id"), partition_by=("side",))
    target = f"{database}.clustered"
    assert ingest.replace_table(rows, target, layout) == 1000
    written = spark.table(target)
    assert written.select("id", "day", "side").exceptAll(rows).count() == 0
    assert "side=1" in written.where("side = 1").inputFiles()[0]
    spans = (written.groupBy(F.input_file_name()).agg(
        F.min("day").alias("low"), F.max("day").alias("high"))).collect()
    assert all(r.high - r.low < 6 for r in spans) or len(spans) <= 2


def test_import_window_is_inclusive(spark, database):
    days = spark.createDataFrame([(NOW - dt.timedelta(days=d),) for d in (0, 30, 31)],
                                 "EnteredDate timestamp")
    job = ingest.ImportJob("Activity_Log", lambda: days, "EnteredDate", 30)
    assert ingest.import_table(spark, job, database=database, log_table=f"{database}.log",
                               now=NOW) == 2


def test_one_failed_import_does_not_stop_the_rest(spark, database):
    def broken():
        raise OSError("no such source")

    jobs = [ingest.ImportJob("bad", broken), ingest.ImportJob("good", lambda: spark.range(2))]
    log = f"{database}.log"
    statuses = dicts(ingest.import_many(spark, jobs, database=database, log_table=log, now=NOW),
                     "table_name")
    assert [r["status"] for r in statuses] == ["error: no such source", "success"]
    assert spark.table(log).count() == 2
    with pytest.raises(OSError):
        ingest.import_table(spark, jobs[0], database=database, log_table=log, now=NOW)


def test_sync_skips_empty_sources_and_checks_counts(spark, database):
    log, target = f"{database}.freshness", f"{database}.t"
    assert ingest.sync_table(spark, spark.range(0), target, log_table=log, now=NOW).startswith(
        "skipped")
    assert not spark.catalog.tableExists(target)
    assert ingest.sync_table(spark, spark.range(4), target, log_table=log, now=NOW) == "success"
    later = NOW + dt.timedelta(hours=1)
    broken = spark.range(1).select(F.raise_error(F.lit("boom")).alias("x"))
    assert ingest.sync_table(spark, broken, target, log_table=log, now=later).startswith("failed")
    latest = dicts(ingest.latest_per(spark.table(log), "table_name", "checked_at"))
    assert len(latest) == 1 and latest[0]["checked_at"] == later


def test_parity(spark):
    row = dicts(ingest.parity(spark.range(3), spark.range(2), "t"))[0]
    assert (row["source_rows"], row["target_rows"], row["passed"]) == (3, 2, False)
    assert dicts(ingest.parity(spark.range(0), spark.range(0), "t"))[0]["passed"] is True


def test_quality_checks(spark):
    frame = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, "c")],
                                  "id int, x string")
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    rows = {r["check_name"]: (r["passed"], r["details"]) for r in dicts(quality.report([
        quality.not_null(frame, "t", ["id", "x"]), quality.unique(frame, "t", ["id"]),
        quality.unique(frame, "t", ["x"]), quality.referential(frame, "t", "x", parent, "x"),
        quality.same_row_count(frame, "t", parent)]))}
    assert rows == {"not_null:id": (False, "2 null values"), "not_null:x": (False, "1 null values"),
                    "unique:id": (False, "1 repeated keys"), "unique:x": (True, "0 repeated keys"),
                    "referential:x": (False, "1 values without a parent"),
                    "same_row_count": (False, "1 rows difference")}


def test_all_checks_at_once_agree_with_single_ones(spark):
    child = spark.createDataFrame([(1, "a", 1.5), (1, None, 1.5), (None, "b", None), (None, "c", 2.0), (3, "c", 2.0)],
                                  "id int, `x y` string, r double")
    parent = spark.createDataFrame([("a", 1), ("b", 1), (None, None), ("a", 2)], "x string, big long")
    single = quality.report([
        quality.not_null(child, "c", ["id", "x y"]), quality.unique(child, "c", ["id"]), quality.unique(child, "c", ["id", "r"]),
        quality.referential(child.withColumnRenamed("x y", "x"), "c", "x", parent, "x"),
        quality.referential(child, "c", "id", parent, "big"), quality.same_row_count(child, "c", parent),
        quality.unique(parent, "p", ["x"])]).drop("check_time")
    together = quality.checked({
        "c": quality.TableChecks(child, ("id", "x y"), (("id",), ("id", "r")), (("x y", "p", "x"), ("id", "p", "big")), ("p",)),
        "p": quality.TableChecks(parent, unique=(("x",),))}).drop("check_time")
    renamed = single.replace("referential:x", "referential:x y", "check_name")
    assert dicts(together, "table_name", "check_name") == dicts(renamed, "table_name", "check_name")
    empty = quality.checked({"c": quality.TableChecks(child.limit(0), ("id",), (("id",),), (("id", "p", "big"),)),
                             "p": quality.TableChecks(parent.limit(0))})
    assert all(r["passed"] for r in dicts(empty)) and empty.count() == 3
    for wrong in (("r", "p", "big"), ("id", "q", "big")):
        with pytest.raises((ValueError, KeyError)):
            quality.checked({"c": quality.TableChecks(child, referential=(wrong,)), "p": quality.TableChecks(parent)})


def test_sync_reads_its_source_once(spark, database):
    reads = spark.sparkContext.accumulator(0)

    def counted(parts):
        for part in parts:
            reads.add(len(part))
            yield part

    source = spark.range(0, 50, 1, 3).mapInPandas(counted, "id long")
    assert ingest.sync_table(spark, source, f"{database}.once", log_table=f"{database}.freshness", now=NOW) == "success"
    assert reads.value == 50 and spark.table(f"{database}.once").count() == 50
    assert dicts(spark.table(f"{database}.freshness"))[0]["row_count"] == 50
    assert ingest.sync_table(spark, spark.createDataFrame([], "id long"), f"{database}.once", log_table=f"{database}.freshness",
                             now=NOW).startswith("skipped")
    assert ingest.sync_table(spark, source.where("id < 0"), f"{database}.once", log_table=f"{database}.freshness",
                             now=NOW).startswith("skipped")
    assert spark.table(f"{database}.once").count() == 50 and not spark.catalog.tableExists(f"{database}.once__new")


@pytest.fixture
def model(spark):
    return WorkforceModel(StarSchemaTables(spark, SMALL), STAR_AS_OF, LOADED_AT)


def test_materialize_and_refresh_record(spark, database, model):
    log = f"{database}.materialized_views"
    for moment in (NOW, NOW + dt.timedelta(days=1)):
        rows = materialize.materialize(spark, model, "employee_summary", cache_database=database,
                                       log_table=log, now=moment)
    assert rows == spark.table(f"{database}.employee_summary").count() == 150
    assert spark.table(log).count() == 2
    newest = dicts(materialize.refreshes(spark, log))
    assert len(newest) == 1 and newest[0]["last_refresh"] == NOW + dt.timedelta(days=1)
    with pytest.raises(KeyError):
        materialize.materialize(spark, model, "business.no_such_view", cache_database=database,
                                log_table=log, now=NOW)
    with pytest.raises(KeyError):
        materialize.materialize(spark, model, "metrics.employee_summary",
                                cache_database=database, log_table=log, now=NOW)


def test_views_answer_sql(spark, model):
    model.register()
    names = [name for tier in VIEWS.values() for name in tier]
    assert len(names) == 32
    assert {t.name for t in spark.catalog.listTables() if t.isTemporary} >= set(names)
    found = spark.sql("SELECT count(*) AS n FROM workforce_demographics WHERE employee_status = ?",
                      args=["Active"]).first()
    assert found.n > 0
    assert spark.sql("SELECT * FROM employee_summary LIMIT 10").count() == 10


def test_as_of_must_be_given(spark):
    with pytest.raises(TypeError):
        WorkforceModel(StarSchemaTables(spark, SMALL))
    assert AS_OF
