"""Tables kept current by key: insert-or-replace and delete, with versions that take effect at once.

A table ``name`` is a view of its newest version, a table ``name__v<number>``. A change writes the next version in full,
then points the view at it, one change of the catalog: a reader sees the rows before or after, never none and never a mixture. The
version before is kept, for readers that began with it; older ones are dropped. Meant for tables that are small beside the facts
(masters, logs, settings), since a change rewrites the table; large tables replace whole days (:mod:`rosterloom.sources.ingest`).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rosterloom.functions import quoted

VERSION = "rosterloom.version"


class ConcurrentChange(RuntimeError):
    """Someone else has changed the table since this change read it."""


def current_version(spark: SparkSession, name: str) -> int:
    """The number of the version that readers see; 0 where there is no such table."""
    if not spark.catalog.tableExists(name):
        return 0
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == VERSION).first()
    if found is None:
        raise ValueError(f"{name} is not kept by key")
    return int(found["value"])


def upsert(spark: SparkSession, name: str, changes: DataFrame, key: Sequence[str], newest_by: Sequence[str] = ()) -> int:
    """Puts ``changes`` in place of the rows of equal ``key`` and adds those of new keys; returns the new version's number.

    Of several changes of one key the one with the greatest ``newest_by`` wins, then the one with the greatest further columns, so
    the result does not depend on the order of rows. Null keys equal each other. The table is made where there is none;
    otherwise columns must have its names (:class:`ValueError`).
    """
    before = current_version(spark, name)
    latest = _one_per_key(changes, key, newest_by)
    if not before:
        return _swap(spark, name, latest, before)
    old = spark.table(_table(name, before))
    if set(old.columns) != set(changes.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(changes.columns))}")
    latest = latest.select(*(quoted(f.name).cast(f.dataType).alias(f.name) for f in old.schema.fields))
    return _swap(spark, name, _without(old, latest, key).unionByName(latest), before)


def delete(spark: SparkSession, name: str, keys: DataFrame, key: Sequence[str]) -> int:
    """Drops the rows whose ``key`` is in ``keys``; null keys equal each other. Returns the new version's number."""
    before = current_version(spark, name)
    if not before:
        raise ValueError(f"no such table: {name}")
    return _swap(spark, name, _without(spark.table(_table(name, before)), keys, key), before)


def _table(name: str, version: int) -> str:
    return f"{name}__v{version}"


def _one_per_key(changes: DataFrame, key: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    order = [*newest_by, *(c for c in changes.columns if c not in {*key, *newest_by})]
    greatest = Window.partitionBy(*map(quoted, key)).orderBy(*(quoted(c).desc_nulls_last() for c in order or key))
    return changes.withColumn("_place", F.row_number().over(greatest)).where(F.col("_place") == 1).drop("_place")


def _without(old: DataFrame, gone: DataFrame, key: Sequence[str]) -> DataFrame:
    named = {c: f"_gone_{i}" for i, c in enumerate(key)}
    gone = gone.select(*(quoted(c).alias(n) for c, n in named.items())).distinct()

    def same(column: str, name: str) -> Column:
        return quoted(column).eqNullSafe(F.col(name))

    return old.join(gone, reduce(lambda a, b: a & b, (same(c, n) for c, n in named.items())), "left_anti")


def _swap(spark: SparkSession, name: str, frame: DataFrame, before: int) -> int:
    """Writes the next version and points the view at it, unless the version read is no longer the newest.

    A number that an interrupted change has used is passed over, and its table dropped with the older versions.
    """
    database, _, bare = name.rpartition(".")
    tables = spark.sql(f"SHOW TABLES IN {database} LIKE '{bare}__v*'" if database else f"SHOW TABLES LIKE '{bare}__v*'")
    numbers = [int(n) for n in (r["tableName"].rpartition("__v")[2] for r in tables.collect()) if n.isdigit()]
    version = max([before, *numbers]) + 1
    frame.write.saveAsTable(_table(name, version))
    if current_version(spark, name) != before:
        spark.sql(f"DROP TABLE {_table(name, version)}")
        raise ConcurrentChange(f"{name} has changed since version {before}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{version}') AS SELECT * FROM {_table(name, version)}")
    for number in numbers:
        if number < before:
            spark.sql(f"DROP TABLE IF EXISTS {_table(name, number)}")
    return version
