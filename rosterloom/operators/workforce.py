"""The join every fact view makes: fact rows to the employee master.

The master holds one row per employee *and pay-date snapshot*, and the join is
on the employee alone, so each fact row meets every snapshot of its employee.
Here the master is first collapsed to its distinct attribute rows, each with
the number of snapshots it stands for (``copies``).  Aggregates multiply by
``copies``; detail views repeat the joined row that often.  Results equal the
plain join's, but

* an employee with very many snapshots is reduced map-side to a few rows before
  anything is shuffled, so the master cannot be the skewed side of the join;
* the master's side is often small enough for AQE to broadcast (it decides on
  the measured size; no hint is given here);
* an employee with very many fact rows is left to AQE, which splits the fact
  side of a left join.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, Window, functions as F

Grain = Literal["snapshot", "latest"]

KEY = "employee_int_id"
COPIES = "copies"


def latest_workforce(workforce: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per employee: the snapshot with the highest pay-date id; of equal ids, the greatest attributes.

    The highest id is a fixed-width maximum in a hash aggregate over two columns; what is joined to the master is one pair of numbers
    per employee, so Spark broadcasts it by its own measure and older snapshots go before any shuffle. Only what ties for the
    newest is ranked, cut to one row per employee on the map side too. A maximum over (id, attributes)
    would sort all snapshots instead.
    """
    kept = [name for name in (columns or workforce.columns)
            if name not in (KEY, "tcpaydt_int_id")]
    people = workforce.where(F.col(KEY).isNotNull()).select(KEY, "tcpaydt_int_id", *kept)
    newest = people.groupBy(KEY).agg(F.max("tcpaydt_int_id").alias("_newest")).withColumnRenamed(KEY, "_person")
    ties = people.join(newest, (F.col(KEY) == F.col("_person")) & F.col("tcpaydt_int_id").eqNullSafe(F.col("_newest")), "left_semi")
    greatest = Window.partitionBy(KEY).orderBy(*(F.desc_nulls_last(name) for name in kept or [KEY]))
    return ties.withColumn("_place", F.row_number().over(greatest)).where(F.col("_place") == 1).select(KEY, *kept)


def workforce_dimension(workforce: DataFrame, attributes: Sequence[str],
                        grain: Grain = "snapshot") -> DataFrame:
    """Distinct attribute rows per employee, with ``copies``.

    ``grain="latest"`` keeps one row per employee, which turns the fan-out off.
    """
    if grain == "latest":
        return (latest_workforce(workforce.select(KEY, "tcpaydt_int_id", *attributes), attributes)
                .withColumn(COPIES, F.lit(1).cast("long")))
    if grain != "snapshot":
        raise ValueError(f"unknown workforce grain: {grain!r}")
    return (workforce.where(F.col(KEY).isNotNull()).groupBy(KEY, *attributes)
            .agg(F.count(F.lit(1)).alias(COPIES)))


def join_workforce(facts: DataFrame, dimension: DataFrame,
                   spread_by: Sequence[str] = ()) -> DataFrame:
    """Left join on the employee; a fact without a match counts once.

    Facts without an employee match nothing, but would all meet in one task: the hash
    of ``spread_by``, columns that tell them apart, deals them out.
    """
    if spread_by:
        nobody = F.when(F.col(KEY).isNull(), F.xxhash64(*spread_by)).otherwise(F.lit(0).cast("long"))
        facts = facts.withColumn("_spread", nobody)
        # Zero for everyone, but no constant, which the optimizer would take out of the join's keys.
        dimension = dimension.withColumn("_spread", F.pmod(F.xxhash64(KEY), F.lit(1)).cast("long"))
        joined = facts.join(dimension, [KEY, "_spread"], "left").drop("_spread")
    else:
        joined = facts.join(dimension, KEY, "left")
    return joined.withColumn(COPIES, F.coalesce(COPIES, F.lit(1).cast("long")))


def join_bucketed(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    """:func:`join_workforce` over tables that are bucketed by the employee into equal buckets: no shuffle.

    Facts without an employee lie in one bucket; they match nothing, so they pass by the join.
    """
    matched = facts.where(F.col(KEY).isNotNull()).join(dimension, KEY, "left")
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in dimension.schema.fields if f.name != KEY]
    nobody = facts.where(F.col(KEY).isNull()).select("*", *others)
    return matched.unionByName(nobody).withColumn(COPIES, F.coalesce(COPIES, F.lit(1).cast("long")))


def heavy_employees(facts: DataFrame, most: int) -> DataFrame:
    """``employee_int_id, _salts`` of the employees with over ``most`` facts: at most facts / ``most`` rows.

    One pre-aggregated pass over the key column alone.
    """
    counts = facts.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > most).select(KEY, F.ceil(F.col("_n") / F.lit(most)).cast("int").alias("_salts"))


def join_split(facts: DataFrame, dimension: DataFrame, deal_by: Sequence[str], most: int = 1_000_000) -> DataFrame:
    """:func:`join_workforce` that splits employees with over ``most`` facts, without the help of AQE.

    Their facts are dealt over as many salts as it takes to get near ``most`` facts each, by the hash of ``deal_by``, columns that
    tell facts apart; their few master rows are copied to each salt. ``heavy`` has at most facts / ``most`` rows of two numbers
    and is broadcast: Spark's own measure would come after it had shuffled the facts. Facts without an employee are dealt out likewise.
    """
    heavy = F.broadcast(heavy_employees(facts, most))
    deal = F.xxhash64(*deal_by)
    dealt = facts.join(heavy, KEY, "left").withColumn("_salt", F.when(F.col(KEY).isNull(), deal).otherwise(
        F.pmod(deal, F.coalesce("_salts", F.lit(1))))).drop("_salts")
    copied = dimension.join(heavy, KEY, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)).cast("long") - 1))).drop("_salts")
    joined = dealt.join(copied, [KEY, "_salt"], "left").drop("_salt")
    return joined.withColumn(COPIES, F.coalesce(COPIES, F.lit(1).cast("long")))


def weighted_sum(column: Column | str, weight: str = COPIES) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.sum(column * F.col(weight))


def expand_copies(joined: DataFrame) -> DataFrame:
    """Repeat each row ``copies`` times: eight bytes per copy, and copies are one person's pay dates."""
    return (joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES))))
            .drop("_copy", COPIES))
