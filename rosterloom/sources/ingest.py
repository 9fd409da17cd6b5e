"""Importing source tables: naming, windows, full reload, parity and the log.

A source is any :class:`DataFrame`: ``spark.read.format("jdbc")`` with
``partitionColumn``/``numPartitions``/``fetchsize`` for a database, or files.
Targets are tables (``spark.table`` names).
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

# The log tables' columns.
IMPORT_LOG = StructType([
    StructField("table_name", StringType()), StructField("imported_at", TimestampType()),
    StructField("row_count", LongType()), StructField("status", StringType())])
FRESHNESS_LOG = StructType([
    StructField("table_name", StringType()), StructField("checked_at", TimestampType()),
    StructField("row_count", LongType()), StructField("status", StringType())])


def target_name(source_name: str) -> str:
    """Table name for a source name: spaces and dashes become underscores, quotes
    and ``$`` go, lower case, and a leading digit is prefixed with ``t_``."""
    name = re.sub(r"[ -]", "_", source_name.strip("'\""))
    name = re.sub(r"[$']", "", name).lower()
    return f"t_{name}" if name[:1].isdigit() else name


def clean_column_names(frame: DataFrame) -> DataFrame:
    """Spaces become underscores; ``$`` and ``#`` are dropped."""
    return frame.toDF(*(re.sub(r"[$#]", "", name.replace(" ", "_")) for name in frame.columns))


def recent(frame: DataFrame, date_column: str, days_back: int, now: dt.datetime) -> DataFrame:
    """Rows dated within ``days_back`` days before ``now``.

    A plain comparison with a literal: JDBC and Parquet sources evaluate it
    themselves.
    """
    return frame.where(F.col(date_column) >= F.lit(now - dt.timedelta(days=days_back)))


@dataclass(frozen=True)
class TableLayout:
    """How a written table is arranged for its readers.

    ``cluster_by`` range-partitions and sorts the rows, so that a date window
    skips files by their statistics; name a further column after the date, so
    that one day holding most rows is still split.  ``partition_by`` makes a
    folder per value, for few-valued columns.  ``bucket_by`` deals the rows into ``buckets``
    files by the hash of these columns, sorted by them: tables with equal buckets join on them without a
    shuffle. It excludes ``cluster_by``.
    """

    cluster_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0

    def __post_init__(self):
        if bool(self.bucket_by) != (self.buckets > 0):
            raise ValueError("bucket_by and buckets go together")
        if self.bucket_by and self.cluster_by:
            raise ValueError("a table is either bucketed or clustered by range")


AS_IS = TableLayout()


@dataclass(frozen=True)
class ImportJob:
    """One table to import; ``read`` opens the source when the import runs."""

    source_name: str
    read: Callable[[], DataFrame]
    date_column: str | None = None
    days_back: int | None = None
    layout: TableLayout = AS_IS


def replace_table(frame: DataFrame, target: str, layout: TableLayout = AS_IS) -> int:
    """Replaces ``target`` by the frame's rows and returns their number.

    The rows are written beside the old table, which goes only when they are complete, and
    counted in the written table, from the files' footers. ``cluster_by`` reads the source once more, to
    sample its ranges.
    """
    beside, rows = write_beside(frame, target, layout)
    swap_in(frame.sparkSession, beside, target, layout)
    return rows


def write_beside(frame: DataFrame, target: str, layout: TableLayout = AS_IS) -> tuple[str, int]:
    """Writes the rows to a table next to ``target``; returns its name and their number."""
    if layout.cluster_by:
        frame = (frame.repartitionByRange(*layout.cluster_by)
                 .sortWithinPartitions(*layout.partition_by, *layout.cluster_by))
    spark, beside = frame.sparkSession, f"{target}__new"
    spark.sql(f"DROP TABLE IF EXISTS {beside}")
    writer = frame.write
    if layout.bucket_by:
        # Dealt as the buckets are, so that each bucket is one file and not one per task.
        writer = (frame.repartition(layout.buckets, *layout.bucket_by).write
                  .bucketBy(layout.buckets, *layout.bucket_by).sortBy(*layout.bucket_by))
    try:
        writer.saveAsTable(beside, partitionBy=list(layout.partition_by) or None)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
        raise
    return beside, spark.table(beside).count()


def swap_in(spark: SparkSession, beside: str, target: str, layout: TableLayout = AS_IS) -> None:
    """Gives ``beside`` the name ``target``, whose old table goes."""
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {target}")
    if layout.partition_by:  # their folders have moved along
        spark.sql(f"MSCK REPAIR TABLE {target} SYNC PARTITIONS")


def overwrite_days(frame: DataFrame, target: str, day: str) -> None:
    """Writes the frame's days into ``target``, a table partitioned by the date ``day``; other days stay as they are.

    Only the partitions that the frame has rows for are replaced, each when its successor is complete, so the table is
    never missing. The table is made where there is none. Rows are dealt to tasks by day; AQE joins small days and
    splits a day that holds most rows.
    """
    spark, names = frame.sparkSession, [c for c in frame.columns if c != day]
    frame = frame.select(*names, day)
    # An insert follows the table's own mode, not the writer's; without it, all other days would go.
    mode = ("partitionOverwriteMode", "dynamic")
    if not spark.catalog.tableExists(target):
        frame.limit(0).write.option(*mode).saveAsTable(target, partitionBy=[day])
    elif not spark.sql(f"DESCRIBE FORMATTED {target}").where(F.col("data_type").contains("=".join(mode))).count():
        spark.sql(f"ALTER TABLE {target} SET SERDEPROPERTIES ('{mode[0]}' = '{mode[1]}')")
    (frame.select(*spark.table(target).columns).hint("rebalance", day).write
     .mode("overwrite").insertInto(target))


def drop_days(spark: SparkSession, target: str, day: str, days: Sequence[dt.date]) -> None:
    """Drops whole days of a table partitioned by ``day``; days it doesn't have are passed over."""
    if days:
        parts = ", ".join(f"PARTITION ({day} = DATE'{d}')" for d in days)
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS {parts}")


def import_days(source: DataFrame, target: str, date_column: str, days_back: int, now: dt.datetime,
                day: str = "import_day") -> None:
    """Imports the days within ``days_back`` before ``now`` into ``target`` and keeps its older ones.

    The window begins with a whole day, as days are replaced whole; ``day`` is added as the partition. Days of the window that
    the source no longer has go. Undated rows are in no window. A target is never missing or half a day.
    """
    spark = source.sparkSession
    first = (now - dt.timedelta(days=days_back)).date()
    fresh = recent(source, date_column, 0, dt.datetime.combine(first, dt.time())).withColumn(
        day, F.col(date_column).cast("date"))
    overwrite_days(fresh, target, day)
    # A few thousand days at most: one row per day of the window.
    held = {r[0] for r in spark.table(target).where(F.col(day) >= F.lit(first)).select(day).distinct().collect()}
    found = {r[0] for r in fresh.select(day).distinct().collect()}
    drop_days(spark, target, day, sorted(held - found))


def _import(job: ImportJob, target: str, now: dt.datetime) -> int:
    frame = job.read()
    if job.date_column and job.days_back:
        frame = recent(frame, job.date_column, job.days_back, now)
    return replace_table(frame, target, job.layout)


def import_table(spark: SparkSession, job: ImportJob, *, database: str, log_table: str,
                 now: dt.datetime) -> int:
    """Full reload of one table, logged; an error is logged and raised again."""
    target = f"{database}.{target_name(job.source_name)}"
    try:
        rows = _import(job, target, now)
    except Exception as error:
        append_log(spark, log_table, IMPORT_LOG, [(target, now, 0, f"error: {error}")])
        raise
    append_log(spark, log_table, IMPORT_LOG, [(target, now, rows, "success")])
    return rows


def import_many(spark: SparkSession, jobs: Sequence[ImportJob], *, database: str,
                log_table: str, now: dt.datetime, at_once: int = 4) -> DataFrame:
    """Imports all jobs, ``at_once`` at a time; one failure does not stop the rest.

    Returns their statuses, which are logged together in the order of the jobs.
    """
    def status(job: ImportJob) -> tuple:
        target = f"{database}.{target_name(job.source_name)}"
        try:
            return target, now, _import(job, target, now), "success"
        except Exception as error:
            return target, now, 0, f"error: {error}"

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        statuses = list(pool.map(status, jobs))
    if statuses:
        append_log(spark, log_table, IMPORT_LOG, statuses)
    return spark.createDataFrame(statuses, IMPORT_LOG)


def sync_table(spark: SparkSession, source: DataFrame, target: str, *, log_table: str,
               now: dt.datetime) -> str:
    """Copies a table with cleaned column names and checks the row counts agree.

    The source is read once: its rows are counted as they pass to the writer (an observed metric of the writing stage, of which
    Spark counts each finished task once), the target's come from the files' footers.
    An empty source leaves the target alone.  Returns the logged status.
    """
    passed = Observation(f"sync {target}")
    try:
        counted = clean_column_names(source).observe(passed, F.count(F.lit(1)).alias("rows"))
        beside, written = write_beside(counted, target)
        expected = passed.get.get("rows", 0)  # no metric where the optimizer knows the source is empty
        if expected == written == 0:
            spark.sql(f"DROP TABLE IF EXISTS {beside}")
            return "skipped: source is empty"
        if written == expected:
            swap_in(spark, beside, target)
            status = "success"
        else:
            spark.sql(f"DROP TABLE IF EXISTS {beside}")
            status = f"failed: {written} of {expected} rows"
    except Exception as error:
        expected, status = 0, f"failed: {error}"
    append_log(spark, log_table, FRESHNESS_LOG, [(target, now, expected, status)])
    return status


def append_log(spark: SparkSession, log_table: str, schema: StructType,
               rows: Sequence[tuple]) -> None:
    spark.createDataFrame(rows, schema).write.mode("append").saveAsTable(log_table)


def latest_per(log: DataFrame, key: str, moment: str) -> DataFrame:
    """The newest log row of each key."""
    newest_first = Window.partitionBy(key).orderBy(F.col(moment).desc_nulls_last())
    return (log.withColumn("_age", F.row_number().over(newest_first))
            .where(F.col("_age") == 1).drop("_age"))


def parity(source: DataFrame, target: DataFrame, table_name: str) -> DataFrame:
    """One row comparing the two row counts, from one aggregate over each side."""
    sides = [frame.select(F.lit(side).alias("side")) for side, frame in
             (("source", source), ("target", target))]
    both = sides[0].unionByName(sides[1]).agg(
        F.count_if(F.col("side") == "source").alias("source_rows"),
        F.count_if(F.col("side") == "target").alias("target_rows"))
    return both.select(F.lit(table_name).alias("table_name"), "source_rows", "target_rows",
                       (F.col("source_rows") == F.col("target_rows")).alias("passed"))


def jdbc_table(spark: SparkSession, table: str, options: Mapping[str, str], *,
               partition_column: str | None = None, bounds: tuple[int, int] | None = None,
               partitions: int = 1, fetch_size: int = 10_000) -> DataFrame:
    """A database table read by many tasks, each one range of ``partition_column``."""
    reader = (spark.read.format("jdbc").options(**options).option("dbtable", table)
              .option("fetchsize", fetch_size))
    if partition_column and bounds:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", bounds[0]).option("upperBound", bounds[1])
                  .option("numPartitions", partitions))
    return reader.load()
