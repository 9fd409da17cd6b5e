"""Distinct counts from bitmap words against plain sets."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rosterloom.operators import bitmaps
from rosterloom.operators.bitmaps import Measures

EDGES = [None, 0, -1, 1, 63, 64, -64, 2**63 - 1, -2**63, 2**40]
MEASURES = Measures(
    counts={"x_all": ("x", None), "x_odd": ("x", "flag"), "x_big": ("x", "y > 10"), "y_all": ("y", None)})


def plain(rows):
    groups = defaultdict(lambda: [set(), set(), set(), set()])
    for k, x, y, flag in rows:
        found = groups[k]
        for at, (value, kept) in enumerate([(x, True), (x, flag), (x, y is not None and y > 10), (y, True)]):
            if value is not None and kept:
                found[at].add(value)
    return {k: tuple(len(s) for s in sets) for k, sets in groups.items()}


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "k string, x long, y long, flag boolean")


ROWS = [(k, x, y, flag) for k in ("a", None) for x in EDGES for y, flag in ((None, True), (11, False), (-5, None), (2**62, True))]


def test_null_negative_and_huge_ids(spark):
    rows = ROWS + [("only nulls", None, None, True)]
    found = bitmaps.distinct_counts(frame_of(spark, rows).repartition(5), ["k"], MEASURES).collect()
    assert {r["k"]: tuple(r)[1:] for r in found} == plain(rows)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-80, 80), st.sampled_from(EDGES)),
                          st.one_of(st.none(), st.integers(-20, 20)), st.one_of(st.none(), st.booleans())), min_size=1, max_size=60))
def test_any_rows_whole_or_merged_from_parts(spark, rows):
    whole = bitmaps.distinct_counts(frame_of(spark, rows), ["k"], MEASURES)
    halves = [bitmaps.states(frame_of(spark, part), ["k"], MEASURES) for part in (rows[::2], rows[1::2]) if part]
    both = halves[0].unionByName(halves[1]) if len(halves) > 1 else halves[0]
    again = bitmaps.counted(bitmaps.merged(both, ["k"], MEASURES), ["k"], MEASURES)
    assert {r["k"]: tuple(r)[1:] for r in whole.collect()} == {r["k"]: tuple(r)[1:] for r in again.collect()} == plain(rows)


def test_totals_are_counted_once_with_two_ids(spark):
    measures = Measures(counts={"nx": ("x", None), "ny": ("y", None)}, sums={"s": F.col("v")},
                        least={"lo": F.col("v")}, most={"hi": F.col("v")})
    frame = spark.createDataFrame([("a", 1, 1, 5), ("a", 1, 2, 6), ("a", None, None, 7)], "k string, x long, y long, v long")
    row = bitmaps.distinct_counts(frame, ["k"], measures).first()
    assert tuple(row) == ("a", 1, 2, 18, 5, 7)


@pytest.mark.parametrize("width", [1, 3, 9, 22, 33, 64])
def test_counts_sharing_a_word_keep_their_bits(spark, width):
    measures = Measures(counts={f"c{k}": ("x", f"x % {width} = {k}") for k in range(width)})
    row = bitmaps.distinct_counts(spark.range(1000).toDF("x").withColumn("k", F.lit(1)), ["k"], measures).first()
    assert [row[f"c{k}"] for k in range(width)] == [len(range(k, 1000, width)) for k in range(width)]
    assert sum(measures.mask(f"c{k}") % 2**64 for k in range(width)).bit_count() == width << measures.neighbours("x")


def test_more_counts_than_bits_are_refused():
    with pytest.raises(ValueError):
        Measures(counts={f"c{k}": ("x", None) for k in range(65)}).neighbours("x")


def test_totals_are_one_row_per_key_beside_the_words(spark):
    """However many slots a key's ids have, sums aren't carried by each."""
    measures = Measures(counts={"nx": ("x", None), "ny": ("y", None)}, sums={"s": F.col("x")}, apart=True)
    frame = spark.range(5000).select(F.lit("a").alias("k"), (F.col("id") * 64).alias("x"), (F.col("id") * 64).alias("y"))
    parts = bitmaps.states(frame, ["k"], measures)
    for found in (parts, bitmaps.merged(parts.unionByName(parts), ["k"], measures)):
        assert found.where("s IS NOT NULL").count() == 1 and found.count() == 10_001
    assert tuple(bitmaps.counted(parts, ["k"], measures).first()) == ("a", 5000, 5000, 64 * 5000 * 4999 // 2)
