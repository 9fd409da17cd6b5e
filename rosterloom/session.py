"""Session settings the library is designed for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The JVM never compiles a method over 8000 bytes, and a view's forty columns make one; above this limit Spark
# generates a method per few columns instead.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")

# The views never name a partition count: AQE sizes shuffles from observed
# bytes, splits skewed join partitions and swaps in broadcast joins only when
# the measured side is below the threshold.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    METHOD_LIMIT[0]: METHOD_LIMIT[1],
    # Call-site capture costs three driver round trips per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "rosterloom", master: str | None = None,
                  **overrides: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``overrides`` win (``.`` written as ``__``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def limit_methods(spark: SparkSession) -> None:
    """Sets :data:`METHOD_LIMIT` in a session made elsewhere, unless it was set there."""
    key, limit = METHOD_LIMIT
    if spark.conf.get(key) == "65535":  # Spark's default
        spark.conf.set(key, limit)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of a block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)
