"""Exact distinct counts from mergeable bitmaps.

A group's ids are kept as a bitmap cut into words of 64 bits. Where several conditional counts go over the same id, a
word holds one bit per count for each of some neighbouring ids: eight counts over eight ids, or one count over 64. So
any number of counts over an id (up to 64) is one OR aggregate in one eight-byte buffer of a hash aggregate, where
``bitmap_construct_agg`` would hold four kilobytes for each bucket and sort. A count is the number of its bits that are set. Two
states of the same group merge by OR, which counts themselves can't: days into months, numbers into departments.

Counts over two ids copy each row once: one further copy per id, not per count.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

ID, SLOT, WORD = "state_id", "state_slot", "state_word"


@dataclass(frozen=True)
class Measures:
    """What is kept of a group.

    ``counts``: by name, the whole-number id to count and a condition (SQL text) or None. ``sums``, ``least``, ``most``: by name,
    the column that is summed or of which the extreme is kept. ``apart`` keeps the totals of several ids in rows of their own, which
    reads the facts twice: worth it where many wide decimals are summed.
    """

    counts: Mapping[str, tuple[str, str | None]]
    sums: Mapping[str, Column] = field(default_factory=dict)
    least: Mapping[str, Column] = field(default_factory=dict)
    most: Mapping[str, Column] = field(default_factory=dict)
    apart: bool = False

    @property
    def ids(self) -> list[str]:
        return list(dict.fromkeys(column for column, _ in self.counts.values()))

    def of_id(self, column: str) -> list[str]:
        return [name for name, (counted_id, _) in self.counts.items() if counted_id == column]

    @property
    def totals(self) -> list[str]:
        return [*self.sums, *self.least, *self.most]

    def neighbours(self, column: str) -> int:
        """log2 of how many ids share a word."""
        width = len(self.of_id(column))
        if width > 64:
            raise ValueError(f"{width} counts over {column}; a word has 64 bits")
        return (64 // width).bit_length() - 1

    def mask(self, name: str) -> int:
        """The bits of a count in a word, as a signed long."""
        column = self.counts[name][0]
        names = self.of_id(column)
        bits = sum(1 << k * len(names) + names.index(name) for k in range(1 << self.neighbours(column)))
        return bits - (1 << 64) if bits >> 63 else bits


def _slot(column: str, measures: Measures) -> Column:
    return F.shiftright(F.col(column).cast("long"), measures.neighbours(column))


def _shifted(value: Column, by: Column) -> Column:
    return F.call_function("shiftleft", value, by)


def _word(column: str, measures: Measures) -> Column:
    """A row's word: the conditions it meets, at its id's place; null for a null id."""
    names = measures.of_id(column)
    flags = reduce(Column.bitwiseOR, (
        F.lit(1 << k if k < 63 else -(1 << 63)).cast("long") if where is None
        else F.when(F.expr(where), F.lit(1 << k if k < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))
        for k, where in enumerate(measures.counts[name][1] for name in names)))
    place = F.col(column).cast("long").bitwiseAND((1 << measures.neighbours(column)) - 1).cast("int")
    return _shifted(flags, place * len(names))


def states(frame: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """Partial states: ``keys``, ``state_id`` (which id), ``state_slot`` (its neighbourhood), ``state_word``, and the totals.

    The totals are on the rows of the first id alone, so that they are counted once, or, ``apart``, on a row of their own per key
    (``state_id`` -1, no slot and word): these come down to one per key before any shuffle, and the words, which are nearly as
    many as the facts, don't carry them. Ids may be null (counted nowhere), negative and as large as a long. A condition
    that is null doesn't hold.
    """
    def totals(here):
        return [kind(here(column)).alias(name) for kind, chosen in (
            (F.sum, measures.sums), (F.min, measures.least), (F.max, measures.most)) for name, column in chosen.items()]

    # One copy of a row per id, by a generator: filters on the keys pass it on their way to the scan, which an Expand would stop.
    copies = [F.struct(F.lit(k).alias(ID), _slot(column, measures).alias(SLOT), _word(column, measures).alias(WORD))
              for k, column in enumerate(measures.ids)]
    word = F.bit_or(WORD).alias(WORD)
    if len(copies) == 1:
        placed = frame.withColumns({ID: F.lit(0), SLOT: _slot(measures.ids[0], measures), WORD: _word(measures.ids[0], measures)})
        return placed.groupBy(*keys, ID, SLOT).agg(word, *totals(lambda column: column))
    if measures.apart and measures.totals:
        words = frame.select(*keys, F.inline(F.array(*copies))).groupBy(*keys, ID, SLOT).agg(word)
        return _with_totals(words, frame.groupBy(*keys).agg(*totals(lambda column: column)), keys)
    placed = frame.select("*", F.inline(F.array(*copies)))
    return placed.groupBy(*keys, ID, SLOT).agg(word, *totals(lambda column: F.when(F.col(ID) == 0, column)))


def _with_totals(words: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Words, and a row of totals per key."""
    no_word = [F.lit(-1).alias(ID), F.lit(None).cast("long").alias(SLOT), F.lit(None).cast("long").alias(WORD)]
    names = [c for c in totals.columns if c not in keys]
    return words.unionByName(totals.select(*keys, *no_word, *names), allowMissingColumns=True)


def _totals(measures: Measures) -> list[Column]:
    return [kind(name).alias(name) for kind, names in (
        (F.sum, measures.sums), (F.min, measures.least), (F.max, measures.most)) for name in names]


def merged(parts: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """States of coarser ``keys`` (or of several parts) from finer ones: words by OR, totals by their own kind."""
    if len(measures.ids) == 1 or not (measures.apart and measures.totals):
        return parts.groupBy(*keys, ID, SLOT).agg(F.bit_or(WORD).alias(WORD), *_totals(measures))
    words = parts.where(F.col(ID) >= 0).groupBy(*keys, ID, SLOT).agg(F.bit_or(WORD).alias(WORD))
    return _with_totals(words, parts.groupBy(*keys).agg(*_totals(measures)), keys)


def bits_of(names: Iterable[str], measures: Measures, word: Column | None = None) -> list[Column]:
    """Per state, how many ids each count has in it."""
    word = F.col(WORD) if word is None else word
    out = []
    for name in names:
        bits = F.bit_count(word.bitwiseAND(F.lit(measures.mask(name)).cast("long"))).cast("long")
        out.append(F.when(F.col(ID) == measures.ids.index(measures.counts[name][0]), bits).alias(name))
    return out


def counted(whole: DataFrame, keys: Sequence[str], measures: Measures, *, names: Iterable[str] | None = None,
            further: Mapping[str, Column] | None = None) -> DataFrame:
    """Counts (``names``, or all) and totals per key, from states in which a (key, id, slot) is one row; ``further``
    columns are summed."""
    names = list(measures.counts if names is None else names)
    counts = [F.coalesce(F.sum(bits), F.lit(0).cast("long")).alias(name)
              for name, bits in zip(names, bits_of(names, measures))]
    return whole.groupBy(*keys).agg(*counts, *_totals(measures), *(F.sum(c).alias(n) for n, c in (further or {}).items()))


def distinct_counts(frame: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """``measures`` of ``frame`` per key."""
    return counted(states(frame, keys, measures), keys, measures)
