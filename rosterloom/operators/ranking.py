"""Top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(frame: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows: each task keeps its own best ``k``, there is no global sort."""
    return frame.orderBy(*order).limit(k)


def top_k_of_many(frame: DataFrame, order: Sequence[Column], k: int, groups: int = 128) -> DataFrame:
    """:func:`top_k` over so many tasks that ``k`` rows of each would be too much for one.

    The tasks' best rows first meet in ``groups`` groups of tasks, of which each keeps its best ``k``.
    """
    tasks = frame.withColumn("_tasks", F.pmod(F.spark_partition_id(), F.lit(groups)))
    return top_k(top_k_per_group(tasks, ["_tasks"], order, k).drop("_tasks"), order, k)


def top_k_per_group(frame: DataFrame, groups: Sequence[str], order: Sequence[Column],
                    k: int) -> DataFrame:
    """First ``k`` rows of each group.

    Spark prunes to ``k`` rows per group within every map task before it
    shuffles (WindowGroupLimit), so a group holding most rows stays small.
    """
    window = Window.partitionBy(*groups).orderBy(*order)
    return (frame.withColumn("_rank", F.row_number().over(window))
            .where(F.col("_rank") <= k).drop("_rank"))
