"""Places of regular-expression matches, as DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rosterloom.llm.common import bound


def matches(text: Column, pattern: str, guard: Column | None = None) -> Column:
    """All leftmost, non-overlapping matches: ``array<struct<first, last, found>>``.

    Code points, end exclusive. The text between matches comes from splitting at the
    pattern, so a place is the length of all that lies before. ``guard`` spares texts
    that cannot match. Null texts have no match. The pattern must not match the empty string.
    """
    def located(pieces: Column, found: Column) -> Column:
        step = F.aggregate(
            F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("before"), found.alias("found")),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,last:int,found:string>>").alias("out")),
            lambda a, x: bound(
                F.struct((a["at"] + F.char_length(x["before"])).alias("first"), F.char_length(x["found"]).alias("n"),
                         x["found"].alias("found")),
                lambda y: F.struct((y["first"] + y["n"]).alias("at"), F.array_append(a["out"], F.struct(
                    y["first"].alias("first"), (y["first"] + y["n"]).alias("last"),
                    y["found"].alias("found"))).alias("out"))),
            lambda a: a["out"])
        return step

    none = F.array().cast("array<struct<first:int,last:int,found:string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = bound(F.struct(F.split(text, pattern, -1).alias("pieces"), found.alias("found")),
                  lambda x: located(x["pieces"], x["found"]))
    test = text.rlike(pattern) if guard is None else guard & text.rlike(pattern)
    return F.when(test, value).otherwise(none)
