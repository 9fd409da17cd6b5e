"""Whole groups in Arrow tasks, and running sums that no single task computes alone."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from rosterloom.llm.common import in_arrow


def _last_group(table: pa.Table, keys: Sequence[str]) -> int:
    """Where the group of the last row begins."""
    start = 0
    for key in keys:
        column = table[key]
        other = np.flatnonzero(pc.not_equal(column, column[-1]).to_numpy())
        start = max(start, int(other[-1]) + 1 if len(other) else 0)
    return start


def in_groups(frame: DataFrame, keys: Sequence[str], run: Callable[[pa.Table], Iterator[pa.RecordBatch]],
              schema: str, order: Sequence[str] = (), size: int = 40_000) -> DataFrame:
    """``run`` over Arrow tables of some ``size`` rows that hold whole groups, groups side by side.

    The keys must not be null. Rows come sorted by the keys and ``order``. Small groups share a call;
    a task holds ``size`` rows or its largest group, so callers bound their groups.
    """
    keys = list(keys)

    def each(batches):
        held, rows, wanted = [], 0, size
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < wanted:
                continue
            table = pa.Table.from_batches(held)
            cut = _last_group(table, keys)
            if cut:
                yield from run(table.slice(0, cut))
                # A copy: a slice would keep the whole table alive.
                held = table.take(pa.array(np.arange(cut, rows))).to_batches()
                rows -= cut
            wanted = max(size, 2 * rows)
        if held:
            yield from run(pa.Table.from_batches(held))

    return in_arrow(frame.repartition(*keys).sortWithinPartitions(*keys, *order), each, schema)


def running_before(sums: DataFrame, keys: Sequence[str], order: str, value: str, name: str,
                   levels: Sequence[int] = (16,)) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same keys with a lesser ``order``, a long.

    ``order`` is unique within the keys. Each level shifts it right by that many bits (descending); a
    window covers the rows that agree above its level only, so none is longer than two to the
    difference of neighbouring levels, whatever a key holds.
    """
    keys, frame, upper, before = list(keys), sums, [], []
    for at, bits in enumerate(levels):
        cell, part = f"_cell{at}", f"_part{at}"
        frame = frame.withColumn(cell, F.shiftright(F.col(order), bits))
        totals = frame.groupBy(*keys, *upper, cell).agg(F.sum(value).alias("_sum"))
        totals = totals.withColumn(part, F.sum("_sum").over(
            Window.partitionBy(*keys, *upper).orderBy(cell)) - F.col("_sum")).drop("_sum")
        before.append((totals, [*keys, *upper, cell], part))
        upper = [*upper, cell]
    last = F.sum(value).over(Window.partitionBy(*keys, *upper).orderBy(order)) - F.col(value)
    frame = frame.withColumn(name, last)
    for totals, on, part in before:
        frame = frame.join(totals, on).withColumn(name, F.col(name) + F.col(part)).drop(part)
    return frame.drop(*upper).withColumn(name, F.col(name).cast("long"))
