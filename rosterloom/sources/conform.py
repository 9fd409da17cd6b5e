"""Feeds that deliver text: casting them to a raw table's types, counting what will not cast, and setting such rows aside."""

from __future__ import annotations

from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from rosterloom.functions import quoted
from rosterloom.session import setting
from rosterloom.sources.ingest import TableLayout, replace_table

OnBad = Literal["raise", "null"]


def _tried(field: StructField) -> Column:
    """The column in its declared type; null where it has no such value."""
    column, target = quoted(field.name), field.dataType
    if isinstance(target, (IntegerType, LongType)):
        # Whole numbers delivered with decimals are rounded, as staging does; most have none and need no decimal.
        return F.coalesce(column.try_cast(target), F.round(column.try_cast("decimal(38,6)"), 0).try_cast(target))
    return column.try_cast(target)


def _delivered(raw: DataFrame, schema: StructType) -> list[StructField]:
    """Fields that come as text although they are declared otherwise."""
    types = {field.name: field.dataType for field in raw.schema.fields}
    return [f for f in schema.fields
            if isinstance(types.get(f.name), StringType) and not isinstance(f.dataType, StringType)]


def conform(raw: DataFrame, schema: StructType, on_bad: OnBad = "raise") -> DataFrame:
    """``raw`` with its text columns in the types of ``schema``; other columns stay.

    A value that will not cast stops the query, or becomes null with ``on_bad="null"``.
    Blank text is null either way.
    """
    if on_bad not in ("raise", "null"):
        raise ValueError(f"unknown choice for bad values: {on_bad!r}")
    changed = {}
    for field in _delivered(raw, schema):
        column, tried = quoted(field.name), _tried(field)
        if on_bad == "raise":
            message = F.concat(F.lit(f"{field.name}: cannot cast "), column)
            tried = F.when(tried.isNull() & (F.trim(column) != ""), F.raise_error(message)).otherwise(tried)
        changed[field.name] = tried.cast(field.dataType).alias(field.name)
    return raw.select(*(changed.get(name, quoted(name)) for name in raw.columns))


def uncastable(raw: DataFrame, table: str, schema: StructType) -> DataFrame:
    """One row per text column of another declared type, counting the values that will not cast."""
    fields = _delivered(raw, schema)
    counted = raw.agg(*(F.count_if(_tried(f).isNull() & (F.trim(quoted(f.name)) != "")).alias(f.name)
                        for f in fields))
    return counted.unpivot([], [quoted(f.name) for f in fields], "column", "bad").select(
        F.concat(F.lit("castable:"), "column").alias("check_name"), F.lit(table).alias("table_name"),
        (F.col("bad") == 0).alias("passed"), F.concat(F.col("bad").cast("string"), F.lit(" bad values")).alias("details"))


FAILED, DELIVERED, ACCEPTED = "_failed", "_delivered", "_accepted"


def quarantine(raw: DataFrame, target: str, schema: StructType) -> tuple[int, int]:
    """Casts a text feed and sets the rows with a value that will not cast aside; returns how many were accepted and rejected.

    One pass over the feed writes one table with a folder for either kind of row, so :func:`accepted` and :func:`rejected` add up to the
    feed and are replaced together. A rejected row keeps the names of its failing columns, in the schema's order, and the
    text of all its delivered columns; an accepted row holds neither. The counts come from the files' footers.
    """
    fields, plain, spark = _delivered(raw, schema), raw.columns, raw.sparkSession
    tried = {f.name: f"_tried_{k}" for k, f in enumerate(fields)}
    fails = {f.name: F.coalesce(F.col(tried[f.name]).isNull() & (F.trim(quoted(f.name)) != ""), F.lit(False)) for f in fields}
    failed = reduce(Column.__or__, fails.values(), F.lit(False))
    # Lists and maps are made for failing rows alone.
    names = F.filter(F.array(*(F.when(bad, F.lit(name)) for name, bad in fails.items())).cast("array<string>"), Column.isNotNull)
    texts = F.create_map(*(part for f in fields for part in (F.lit(f.name), quoted(f.name)))).cast("map<string,string>")
    marked = raw.select("*", *(_tried(f).cast(f.dataType).alias(tried[f.name]) for f in fields)).select(
        *(F.col(tried[name]).alias(name) if name in tried else quoted(name) for name in plain),
        F.when(failed, names).alias(FAILED), F.when(failed, texts).alias(DELIVERED), (~failed).alias(ACCEPTED))
    # A task keeps both folders' files open, so its rows needn't be sorted by folder.
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "2"):
        replace_table(marked, target, TableLayout(partition_by=(ACCEPTED,)))
    return accepted(spark, target).count(), rejected(spark, target).count()


def accepted(spark: SparkSession, target: str) -> DataFrame:
    """The typed rows of a quarantined feed; files of rejected rows are not read."""
    return spark.table(target).where(F.col(ACCEPTED)).drop(FAILED, DELIVERED, ACCEPTED)


def rejected(spark: SparkSession, target: str) -> DataFrame:
    """The rejected rows as they were delivered, with the list ``_failed``: corrected, they are a feed again.

    Columns that were declared otherwise than as text are text here, as :func:`quarantine` met them.
    """
    rows = spark.table(target).where(~F.col(ACCEPTED))
    return rows.select(*(_as_delivered(f) for f in rows.schema.fields if f.name not in (DELIVERED, ACCEPTED)))


def _as_delivered(field: StructField) -> Column:
    """The delivered text; a column that came in its own type is not among the texts and stays as it is."""
    if isinstance(field.dataType, (StringType, ArrayType)):
        return quoted(field.name)
    text = F.col(DELIVERED)
    return F.when(F.map_contains_key(text, F.lit(field.name)), text[field.name]).otherwise(
        quoted(field.name).cast("string")).alias(field.name)
