"""Best-fit packing of tokenised documents into training sequences.

A configuration linear program over the histogram of piece lengths is solved by
multiplicative weights; a knapsack dynamic program prices the configurations. The
fractional solution is rounded, and what rounding leaves is packed best-fit
decreasing, on the histogram too. All of this sees at most one number per length, so it
does not grow with the corpus; pieces meet their places through ranks within a length.
"""

from __future__ import annotations

import base64
import bisect
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rosterloom.llm.common import in_arrow, kept, texts

CAPACITY, END_ID = 1024, 2
_SHARES = (1.0, 0.75, 0.5, 0.25, 0.1, 0.02)
Pattern = tuple[tuple[int, int], ...]  # (length, copies), longest first

_PIECES = "doc_id long, piece int, start long, length long, ids binary"
_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids", pa.binary())])


class _Encoder(dict):
    """Little-endian ids of a text's words, kept by word (byte-level BPE never crosses words).

    A space that a non-space follows begins a word, so a text is the
    concatenation of its parts between such spaces. Ids of unseen words come from the
    vocabulary's ranks through tiktoken, several times faster than, and tested equal to,
    the tokenizers file, which still encodes whatever holds one of its special strings.
    """

    LIMIT = 64_000_000  # bytes, also within one text
    _odd = re.compile(r" \s").search
    _spaces = re.compile(r" (?=\S)").split

    def __init__(self, tokenizer: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer
        super().__init__()
        self._full = Tokenizer.from_file(tokenizer)
        self._special = [t.content for t in self._full.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges,
                                       special_tokens={})
        self._bytes = 0

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self._special):
            ids = self._full.encode(text, add_special_tokens=False).ids
        else:
            ids = self._fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        base = word.rstrip(".,;:!?")
        if base and base != word and base[-1].isalpha():
            value = self[base] + self.encode(word[len(base):])
        else:
            value = self.encode(" " + word)
        self._bytes += 140 + len(word) + len(value)
        if self._bytes > self.LIMIT:
            self.clear()
            self._bytes = 0
        if len(word) < 100:
            self[word] = value
        return value

    def text(self, text: str) -> bytes:
        lines = text.split("\n")
        if self._odd(text) or any(s in text for s in self._special):
            first, *rest = self._spaces(text)
            return self.encode(first) + b"".join(map(self.__getitem__, rest))
        if not all(lines) or any(x[0].isspace() or x[-1].isspace() for x in lines):
            first, *rest = text.split(" ")
            return self.encode(first) + b"".join(map(self.__getitem__, rest))
        # A lone newline between non-spaces is a token of its own.
        out = []
        for line in lines:
            first, *rest = line.split(" ")
            out.append(self.encode(first) + b"".join(map(self.__getitem__, rest)))
        return self.encode("\n").join(out)


@lru_cache(2)
def _encoder(tokenizer: str, ranks: str, pattern: str) -> _Encoder:
    return _Encoder(tokenizer, ranks, pattern)


def pieces(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, capacity: int = CAPACITY,
           end_id: int = END_ID) -> DataFrame:
    """Token pieces of all documents: ``doc_id, piece, start, length, ids``.

    ``ids`` holds unsigned 32-bit little-endian ids. Every document ends in ``end_id``;
    one longer than ``capacity`` is cut into full pieces, of which the first takes the
    remainder. A null or empty text is the end id alone; repeated rows give
    repeated pieces; other columns are not read. One narrow pass, no shuffle.
    """
    def cut(batches):
        encoder, end = _encoder(tokenizer, ranks, pattern), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            size = 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.text(text.as_py() or "") + end
                total, start, piece = len(ids) // 4, 0, 0
                while start < total:
                    length = total - start if total - start <= capacity else (total - start) % capacity or capacity
                    rows.append((key, piece, start, length, ids[4 * start:4 * (start + length)]))
                    start, piece = start + length, piece + 1
                size += len(ids)
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    return in_arrow(texts(docs), cut, _PIECES)


def _knapsack(lengths, copies, values, capacity: int) -> list[tuple[int, int]]:
    """The most valuable (index, copies) within ``capacity``, at most ``copies`` of each."""
    items = []
    for i, (length, most) in enumerate(zip(lengths, copies)):
        most, step = min(int(most), capacity // int(length)), 1
        while most > 0:
            take = min(step, most)
            items.append((i, take, take * int(length), take * values[i]))
            most, step = most - take, step * 2
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(items), capacity + 1), bool)
    for k, (_, _, weight, value) in enumerate(items):
        offer = best[:-weight] + value
        better = offer > best[weight:]
        taken[k, weight:] = better
        best[weight:] = np.where(better, offer, best[weight:])
    room, found = capacity, {}
    for k in range(len(items) - 1, -1, -1):
        if taken[k, room]:
            i, take, weight, _ = items[k]
            found[i] = found.get(i, 0) + take
            room -= weight
    return list(found.items())


def _fractional(lengths, demand, capacity: int, rounds: int, rate: float):
    """Configurations and how often each is used, by multiplicative weights.

    A length's weight falls as its demand is covered, so that each priced configuration serves
    what is still short; it is used until it covers one of its lengths once.
    """
    weights, used, covered = lengths / capacity, {}, np.zeros(len(lengths))
    for _ in range(rounds):
        chosen = _knapsack(lengths, demand, weights * np.exp(-rate * covered), capacity)
        times = min(demand[i] / a for i, a in chosen)
        key = tuple(sorted(chosen))
        used[key] = used.get(key, 0.0) + times
        for i, a in chosen:
            covered[i] += a * times / demand[i]
    # Scaled so that the best covered length is covered once: an underestimate that rounding completes.
    return {k: v / covered.max() for k, v in used.items()}


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on a histogram: bins of equal content are one entry."""
    by_gap: dict[int, list[list]] = {}
    gaps: list[int] = []

    def put(gap, pattern, times):
        if times:
            if gap not in by_gap:
                by_gap[gap] = []
                bisect.insort(gaps, gap)
            by_gap[gap].append([pattern, times])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                put(capacity, (), left)
                continue
            gap = gaps[at]
            pattern, times = by_gap[gap].pop()
            each = gap // length
            full = min(times, left // each)
            put(gap - each * length, (*pattern, (length, each)), full)
            left, times = left - full * each, times - full
            if times and left and left < each:
                put(gap - left * length, (*pattern, (length, left)), 1)
                left, times = 0, times - 1
            put(gap, pattern, times)
            if not by_gap[gap]:
                del by_gap[gap]
                gaps.remove(gap)
    return [(p, n) for group in by_gap.values() for p, n in group if p]


def plan(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = 150,
         rate: float = 4.0) -> list[tuple[Pattern, int]]:
    """Configurations with whole multiplicities that hold every piece exactly once.

    Full-length pieces take a sequence each. Rounding takes the integer part of each
    configuration's use, then one more use where at least half was cut off, as long as
    pieces are left for it and it fills the sequence; the rest is packed best-fit decreasing.
    Of several shares of the fractional solution that are rounded so, the one with the fewest
    sequences is kept.
    """
    small = {n: c for n, c in counts.items() if c and n < capacity}
    whole = [(((capacity, 1),), counts[capacity])] if counts.get(capacity) else []
    if not small:
        return whole
    lengths = np.array(sorted(small, reverse=True))
    demand = np.array([small[n] for n in lengths], float)
    used = {tuple((int(lengths[i]), a) for i, a in k): times
            for k, times in _fractional(lengths, demand, capacity, rounds, rate).items()}
    tried = (_rounded({k: share * v for k, v in used.items()}, small, capacity) for share in _SHARES)
    return whole + min(tried, key=lambda bins: sum(times for _, times in bins))


def _rounded(used: dict[Pattern, float], counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    left, out = dict(counts), []

    def take(pattern, times):
        times = min([times, *(left[n] // a for n, a in pattern)])
        if times > 0:
            out.append((pattern, times))
            for n, a in pattern:
                left[n] -= a * times

    for pattern in sorted(used, key=used.get, reverse=True):
        take(pattern, int(used[pattern]))
    for pattern in sorted(used, key=lambda k: used[k] % 1, reverse=True):
        if sum(n * a for n, a in pattern) == capacity and used[pattern] % 1 >= 0.5:
            take(pattern, 1)
    return out + _best_fit({n: c for n, c in left.items() if c}, capacity)


def place(parts: DataFrame, capacity: int = CAPACITY, rounds: int = 150) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``doc_id, piece, start, length``.

    ``parts`` is read twice, so it should be a written table. Only the histogram
    (at most ``capacity`` rows) comes to the driver. Ranks within a length are counted in
    hashed buckets, so a length that holds most pieces is spread over all of them.
    """
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if counts and max(counts) > capacity:
        raise ValueError(f"a piece of {max(counts)} ids exceeds {capacity}")
    slots: dict[int, list[tuple[int, int, int, int]]] = {}  # length: first rank, first sequence, copies, offset
    filled: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan(counts, capacity, rounds):
        offset = 0
        for length, copies in pattern:
            slots.setdefault(length, []).append((filled.get(length, 0), sequence, copies, offset))
            filled[length] = filled.get(length, 0) + copies * times
            offset += length * copies
        sequence += times
    slots_of = {n: np.array(s) for n, s in slots.items()}

    def placed(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        out = np.empty((len(length), 2), np.int64)
        for one in np.unique(length):
            at, known = length == one, slots_of[one]
            row = known[np.searchsorted(known[:, 0], rank[at], "right") - 1]
            k = rank[at] - row[:, 0]
            out[at, 0] = row[:, 1] + k // row[:, 2]
            out[at, 1] = row[:, 3] + k % row[:, 2] * one
        return out

    def with_places(batches):
        for batch in batches:
            *columns, rank = batch.columns
            found = placed(columns[names.index("length")].to_numpy(), rank.to_numpy())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found[:, 0]), pa.array(found[:, 1])],
                                             [*names, "sequence_id", "offset"])

    buckets = max(1, int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    names = parts.columns
    keyed = parts.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = (keyed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
              .withColumn("_before", F.sum("_n").over(
                  Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")).drop("_n"))
    order = Window.partitionBy("length", "_bucket").orderBy(*names)
    ranked = (keyed.withColumn("_rank", F.row_number().over(order).cast("long") - 1)
              .join(before, ["length", "_bucket"]).select(*names, (F.col("_rank") + F.col("_before")).alias("_rank")))
    # Through the same kind of worker as the pass before: idle workers of another kind would hold memory beside it.
    return in_arrow(ranked, with_places, StructType([
        *parts.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]))


def tokenizer_files() -> tuple[str, str, str]:
    """Paths of the public byte-level vocabulary, and its word pattern."""
    import public_tokenizers
    return (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
            public_tokenizers.PATTERN)


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
         files: tuple[str, str, str] | None = None, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their places: ``doc_id, piece, start, length, ids_crc32``,
    ``ids`` if asked for, ``sequence_id, offset``. An empty table gives an empty result."""
    parts = pieces(docs, *(files or tokenizer_files()), capacity, end_id)
    parts = parts.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         *(["ids"] if with_ids else []))
    return place(kept(parts, "pieces"), capacity)
