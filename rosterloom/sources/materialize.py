"""Materialised views: a view's rows as a table, and the refresh record."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from rosterloom.model import WorkforceModel
from rosterloom.sources.ingest import (
    AS_IS,
    TableLayout,
    append_log,
    latest_per,
    replace_table,
)

# The refresh record's columns.
REFRESH_LOG = StructType([
    StructField("view_name", StringType()), StructField("last_refresh", TimestampType()),
    StructField("row_count", LongType()), StructField("refresh_status", StringType())])
DEFAULT_TIER = "business"


def materialize(spark: SparkSession, model: WorkforceModel, view_name: str, *,
                cache_database: str, log_table: str, now: dt.datetime,
                layout: TableLayout = AS_IS) -> int:
    """Writes ``view_name`` (tier ``business`` unless qualified) to a table.

    An unknown view raises :class:`KeyError`; a failed refresh is recorded and
    raised again.  Returns the row count.
    """
    qualified = view_name if "." in view_name else f"{DEFAULT_TIER}.{view_name}"
    frame = model.view(qualified)
    target = f"{cache_database}.{qualified.rpartition('.')[2]}"
    try:
        rows = replace_table(frame, target, layout)
    except Exception as error:
        append_log(spark, log_table, REFRESH_LOG, [(view_name, now, 0, f"failed: {error}")])
        raise
    append_log(spark, log_table, REFRESH_LOG, [(view_name, now, rows, "success")])
    return rows


def refreshes(spark: SparkSession, log_table: str) -> DataFrame:
    """The newest refresh of each view."""
    return latest_per(spark.table(log_table), "view_name", "last_refresh")
