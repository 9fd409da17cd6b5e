"""A place every executor can write to, for tables made along the way."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; where it names none, one of the warehouse.

    Both are shared by all executors, on any master.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch").rstrip("/")


def fresh_database(spark: SparkSession, purpose: str) -> str:
    """An empty database for ``purpose`` under the shared folder; returns its name.

    What an earlier use for the same purpose in this application left is dropped, so
    tables do not pile up.
    """
    application = re.sub(r"\W", "_", spark.sparkContext.applicationId)
    name = f"rosterloom_{purpose}_{application}"
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}/{name}'")
    return name
