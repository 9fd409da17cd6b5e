"""Spelling variants: words one letter apart, found in a bit-sliced position index.

The vocabulary is cut into lanes of 64 words. For every position and letter a lane has one machine
word whose bits name the lane's words with that letter there. A word is looked up letter by letter: four
bit sets per lane say which words agree so far without an error, and with one replaced, one missing
or one additional letter; the latter two read the index one position earlier or later. Each step is a few
operations on machine words, done for many lookups at once.

A lookup need not meet the whole vocabulary: of two words one letter apart, the shorter with ``m`` letters, either the
first ``ceil(m / 2)`` or the last ``floor(m / 2)`` letters agree. Words meet in the buckets of these ends; the
recurrence starts behind the end that agrees. A bucket of any size is cut into index blocks
and lookup blocks that meet pair by pair in tasks of their own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterloom.llm.common import in_arrow, kept, texts
from rosterloom.llm.grouped import in_groups

MIN_LENGTH, MIN_COUNT, DOMINANCE, DAMAGED = 7, 2, 10, 31
BLOCK = 65_536  # words of an index block, and of a lookup block
_LETTERS = 26 + 64 + 1  # a to z, U+00C0 to U+00FF, and no letter
_NONE = _LETTERS - 1
_SLICE = 1 << 18
_FLUSH = 200_000

_PAIRS = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def words(docs: DataFrame, min_length: int = MIN_LENGTH, damaged: int = DAMAGED) -> DataFrame:
    """``word, n``: how often each word of ``min_length`` letters or more occurs in all texts.

    Words are maximal runs of A to Z, a to z and U+00C0 to U+00FF, of which A to Z are lower-cased. A run whose
    CRC-32 with the ``doc_id`` is divisible by ``damaged`` loses one letter. A null text has no words;
    a null ``doc_id`` counts as an empty one. Repeated rows count again; other columns are not read.
    Counts are summed within tasks before they are shuffled.
    """
    # A shorter run can't give a word: losing a letter only shortens it.
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_length).findall

    def count(batches):
        found: Counter[str] = Counter()
        size = 0

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                head = "" if key is None else str(key)
                # Lower-casing bytes changes A to Z alone.
                for word, times in Counter(runs(text.encode().lower().decode())).items():
                    code = zlib.crc32(f"{head}:{word}".encode())
                    if code % damaged == 0:
                        at = code % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    if word not in found:
                        size += 60 + len(word)
                    found[word] += times
                    if len(found) > _FLUSH or size > 32_000_000:
                        yield rows()
                        found.clear()
                        size = 0
        if found:
            yield rows()

    return (in_arrow(texts(docs), count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _codes(found: list[str], width: int) -> np.ndarray:
    """Letter numbers, one row per word, filled up with ``_NONE``."""
    points = np.array(found, dtype=f"U{width}").view(np.uint32).reshape(len(found), width)
    return np.where(points == 0, _NONE, np.where(points < 128, points - 97, points - 192 + 26)).astype(np.int64)


class _Lanes:
    """The bit-sliced index of some buckets: words of ``m`` and ``m + 1`` letters."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, m: int, group: np.ndarray, indexed: np.ndarray):
        rows = np.flatnonzero(indexed)
        sizes = np.bincount(group[rows], minlength=int(group[-1]) + 1)
        self.per_group = -(-sizes // 64)
        self.first_lane = np.concatenate(([0], np.cumsum(self.per_group)[:-1]))
        rank = np.arange(len(rows)) - np.concatenate(([0], np.cumsum(sizes)[:-1]))[group[rows]]
        self.lane = self.first_lane[group[rows]] + rank // 64
        self.bit = np.uint64(1) << (rank % 64).astype(np.uint64)
        self.count = int(self.per_group.sum())
        self.word_at = np.full(self.count * 64, -1, np.int64)
        self.word_at[self.lane * 64 + rank % 64] = rows
        self.codes = codes[rows]
        self.shorter, self.longer = self._bits(lengths[rows] == m), self._bits(lengths[rows] == m + 1)
        self._tables: dict[int, np.ndarray] = {}

    def _bits(self, chosen: np.ndarray) -> np.ndarray:
        out = np.zeros(self.count, np.uint64)
        np.bitwise_or.at(out, self.lane[chosen], self.bit[chosen])
        return out

    def table(self, position: int) -> np.ndarray:
        """Bits by lane and letter. Three positions are kept, or as many as take little memory."""
        if position not in self._tables:
            if len(self._tables) >= max(3, 32_000_000 // (self.count * _LETTERS * 8)):
                del self._tables[next(iter(self._tables))]
            bits = np.zeros(self.count * _LETTERS, np.uint64)
            if 0 <= position < self.codes.shape[1]:
                letters = self.codes[:, position]
                np.bitwise_or.at(bits, self.lane * _LETTERS + letters, self.bit)
                bits.reshape(-1, _LETTERS)[:, _NONE] = 0
            self._tables[position] = bits
        return self._tables[position]


def _search(lanes: _Lanes, codes: np.ndarray, lane: np.ndarray, skip: int, length: int, m: int) -> np.ndarray:
    """Bits of the words one letter from each looked-up word of ``length`` letters, in its lane."""
    shorter, longer = lanes.shorter[lane], lanes.longer[lane]
    equal = shorter | longer
    replaced, fewer, more = (np.zeros(len(lane), np.uint64) for _ in range(3))
    base = lane * _LETTERS
    for j in range(skip, length):
        at = base + codes[:, j]
        earlier, here, later = (lanes.table(p)[at] for p in (j - 1, j, j + 1))
        more = (more | equal) & later
        replaced = (replaced & here) | (equal & ~here & (longer if j >= m else ~np.uint64(0)))
        fewer = (fewer & earlier) | equal
        equal = equal & here
    return (replaced & shorter) | ((more | equal) & longer) if length == m else fewer & shorter


def _pairs(found: list[str], group: np.ndarray, indexed: np.ndarray, looked_up: np.ndarray, m: int, side: int):
    """(looked-up row, near row) of buckets of one end: every ordered pair once over both ends."""
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    head, tail = -(-m // 2), m // 2
    codes = plain = _codes(found, m + 1)
    if side:
        codes = _codes([w[::-1] for w in found], m + 1)
    lanes = _Lanes(codes, lengths, m, group, indexed)
    out = []
    for length in (m, m + 1):
        rows = np.flatnonzero(looked_up & (lengths == length))
        widths = lanes.per_group[group[rows]]
        ends = np.cumsum(widths)
        start = 0
        while start < len(rows):
            # As many rows as fill a slice; a row's lanes are one block's at most.
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _SLICE, "right")))
            some, wide = rows[start:stop], widths[start:stop]
            row = np.repeat(some, wide)
            lane = (np.arange(len(row)) - np.repeat(np.cumsum(wide) - wide, wide)
                    + np.repeat(lanes.first_lane[group[some]], wide))
            if len(row):
                bits = _search(lanes, codes[row], lane, tail if side else head, length, m)
                hit = np.flatnonzero(bits)
                element, bit = np.nonzero(np.unpackbits(
                    bits[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                near = lanes.word_at[lane[hit[element]] * 64 + bit]
                row = row[hit[element]]
                if side:  # pairs whose heads agree too are found there
                    other = (plain[row, :head] != plain[near, :head]).any(axis=1)
                    row, near = row[other], near[other]
                out.append((row, near))
            start = stop
    return [np.concatenate(x) for x in zip(*out)] if out else (np.zeros(0, np.int64),) * 2


def _found(table: pa.Table):
    """Per looked-up word and call: how many words are near, and the most frequent of them."""
    group_keys = [table[c].combine_chunks() for c in ("m", "side", "gram", "i", "q")]
    new = np.zeros(table.num_rows, bool)
    for column in group_keys:
        values = column.dictionary_encode().indices.to_numpy()
        new[1:] |= values[1:] != values[:-1]
    group = np.cumsum(new)
    found, n = table["word"].to_pylist(), table["n"].to_numpy()
    m, side = table["m"].to_numpy(), table["side"].to_numpy()
    indexed, looked_up = (table[c].to_numpy() for c in ("indexed", "looked_up"))
    edges = np.flatnonzero(np.concatenate(([True], (m[1:] != m[:-1]) | (side[1:] != side[:-1]), [True])))
    for a, b in zip(edges[:-1], edges[1:]):
        row, near = _pairs(found[a:b], group[a:b] - group[a], indexed[a:b], looked_up[a:b], int(m[a]), int(side[a]))
        if not len(row):
            continue
        # Rows of a group are in the order of their words, so the least row settles ties.
        order = np.lexsort((near, -n[a:b][near], row))
        row, near = row[order], near[order]
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        times = np.diff(np.concatenate((first, [len(row)])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([found[a + r] for r in row[first]], pa.string()), pa.array(times, pa.int64()),
             pa.array(n[a:b][near[first]], pa.int64()),
             pa.array([found[a + r] for r in near[first]], pa.string())], schema=_PAIRS)


def near_words(vocabulary: DataFrame, min_length: int = MIN_LENGTH, block: int = BLOCK) -> DataFrame:
    """``word, n_near, best, best_n`` of the words in ``vocabulary(word, n)`` that have a near word.

    Near is one inserted, deleted or replaced letter; ``best`` is the near word of the largest ``n``, the
    least in code-point order among equals. Words are distinct, of ``min_length`` letters or more.
    A bucket of up to ``block`` words is one group; a larger one of B words is ``(B / block) ** 2``
    groups of at most about ``2 * block`` rows.
    """
    length = F.char_length("word")
    ends = []
    for m in (length, length - 1):
        ends += [F.struct(m.alias("m"), F.lit(0).alias("side"), F.substring("word", F.lit(1), F.ceil(m / 2).cast("int")).alias("gram")),
                 F.struct(m.alias("m"), F.lit(1).alias("side"), F.right("word", F.floor(m / 2).cast("int")).alias("gram"))]
    entries = (vocabulary.select("word", "n", F.explode(F.array(*ends)).alias("e"))
               .select("word", "n", "e.*").where(F.col("m") >= min_length))
    bucket = ["m", "side", "gram"]
    sizes = (entries.groupBy(*bucket).agg(F.count("*").alias("size")).where("size > 1")
             .select(*bucket, F.ceil(F.col("size") / block).cast("int").alias("blocks")))
    part = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    numbers = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = entries.join(sizes, bucket).withColumn("own", part)
    dealt = own.select("*", F.explode(F.array_distinct(F.concat(
        F.transform(numbers, lambda q: F.struct(F.col("own").alias("i"), q.alias("q"))),
        F.transform(numbers, lambda i: F.struct(i.alias("i"), F.col("own").alias("q")))))).alias("at")).select(
        *bucket, F.col("at.i").alias("i"), F.col("at.q").alias("q"), "word", "n",
        (F.col("at.i") == F.col("own")).alias("indexed"), (F.col("at.q") == F.col("own")).alias("looked_up"))
    partial = in_groups(dealt, [*bucket, "i", "q"], _found, "word string, near long, best_n long, best string", ["word"])
    return partial.groupBy("word").agg(
        F.sum("near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("rank"), "best")).alias("least")).select(
        "word", "n_near", F.col("least.best").alias("best"), (-F.col("least.rank")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` by following ``forms(word, form)`` to the last; a form must not lead back to its word.

    Every round doubles the steps taken, so a chain of k forms takes about log2(k) rounds. Each round
    is a written table.
    """
    links = kept(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = kept(links.join(onward, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        links = step.drop("moved")
        if step.where("moved").isEmpty():
            return links


def spelling_groups(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, dominance: int = DOMINANCE,
                    damaged: int = DAMAGED) -> DataFrame:
    """The words of all texts with their dominant spelling: ``word, form, root, n, n_near, form_n``.

    Words occur ``min_count`` times or more. A word's form is its most frequent near word, if that is at least ``dominance`` times as
    frequent; forms grow in ``n``, so following them ends, at the root. Null and empty texts have no words, a very
    long text is read whole, and an empty table gives an empty result.
    """
    if dominance < 2:
        raise ValueError("dominance must be 2 or more, else forms could lead in circles")
    vocabulary = kept(words(docs, min_length, damaged).where(F.col("n") >= min_count), "vocabulary")
    best = kept(near_words(vocabulary, min_length), "near")
    # Divided rather than multiplied, which could overflow.
    judged = kept(vocabulary.join(best, "word", "left").withColumn(
        "strong", F.coalesce(F.expr(f"best_n div {int(dominance)}") >= F.col("n"), F.lit(False))).select(
        "word", F.when(F.col("strong"), F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("strong"), F.col("best_n")).alias("form_n")), "forms")
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
