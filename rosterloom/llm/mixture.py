"""Mixture-controlled packing: deficit round robin over source queues.

Every source is a queue of token pieces. A window of ``capacity`` tokens adds each source's share of
it to the source's deficit and is filled by serving, turn after turn, the queue with the largest deficit; what a queue
gets too little or too much of is carried to the next window. A document is cut where its turn or the window ends.

The queues are also cut across tasks: a piece's place in its queue, scaled by the source's share, is the virtual time
at which even service would reach it. A span of virtual time is one partition, holding all sources in
proportion; running sums over partitions say where its windows begin in the output and which deficits it takes over
from the partitions before it. So partitions are served independently, and the sequences come out as from one pass.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterloom.llm.common import in_arrow, kept
from rosterloom.llm.grouped import in_groups, running_before

CAPACITY, END_ID = 2048, 1
TURN = 64  # least tokens of a turn
SPAN = 1 << 20  # tokens of a partition, nearly
BYTES = 4_000_000  # of texts that are encoded together, nearly

_DOCS = "row long, doc_id long, source string, doc_tokens long, ids binary"
_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("source", pa.string()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
_CUTS = "row long, start long, length long, sequence_id long, offset long"
_CUTS_ARROW = pa.schema([(c, pa.int64()) for c in ("row", "start", "length", "sequence_id", "offset")])


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if printable, else the next above 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class _Words(dict):
    """Little-endian ids by space-separated part; the tokenizer drops white space and never joins over it.

    Texts are split and their parts made distinct by Arrow, a slice at a time, so that the cache is asked once for each
    distinct part of a slice and all unseen parts of a slice are encoded together. Parts of plain letters, digits and signs
    are split by the tokenizer's own rule and encoded by tiktoken from the same vocabulary, where a zero byte stands for the
    end of a word: several times faster than, and tested equal to, the tokenizers file, which encodes all other parts.
    Bounded in bytes, also within one text: beyond that it starts anew from the slice at hand, whose first parts are the common ones.
    """

    LIMIT = 64_000_000
    SLICE = 1_000_000  # parts
    CALL = 50_000  # parts encoded at once
    END = "</w>"
    _plain = re.compile("[!-~À-ÿ]+").fullmatch
    # The tokenizer's fixed splitting rule, for the lower-cased characters of plain parts with a newline after each.
    _pieces = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\n]+|\n").findall

    def __init__(self, path: str, kind: str):
        import tiktoken
        from tokenizers import Tokenizer
        super().__init__()
        self._full = Tokenizer.from_file(path)
        special, byte = {t.content for t in self._full.get_added_tokens_decoder().values()}, _byte_of()
        ranks = {}
        for word, number in self._full.get_vocab(with_added_tokens=False).items():
            if word not in special:
                whole = word.removesuffix(self.END)
                ranks[bytes(byte[c] for c in whole) + (b"\0" if word != whole else b"")] = number
        self._fast = tiktoken.Encoding("ranks", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self._newline = ranks[b"\n\0"]
        self._kind = kind
        self._bytes = 0

    def _together(self, parts: list[str]) -> list[bytes]:
        """Ids of plain parts, told apart by the newline's id, which no plain part has."""
        pieces = self._pieces("\n".join(parts).lower() + "\n")
        ids = np.array(self._fast.encode_ordinary("\0".join(pieces) + "\0"), self._kind)
        ends, width, data = np.flatnonzero(ids == self._newline), ids.itemsize, ids.tobytes()
        starts = np.concatenate(([0], ends[:-1] + 1))
        return [data[a:b] for a, b in zip((starts * width).tolist(), (ends * width).tolist())]

    def _encoded(self, parts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(parts), self.CALL):
            some = parts[at:at + self.CALL]
            joined = "".join(some)
            if all(some) and self._plain(joined) and "<|" not in joined:
                out += self._together(some)
                continue
            plain = [bool(self._plain(part)) and "<|" not in part for part in some]
            fast = iter(self._together([part for part, yes in zip(some, plain) if yes]) if any(plain) else ())
            out += [next(fast) if yes else np.array(self._full.encode(part, add_special_tokens=False).ids, self._kind).tobytes()
                    for part, yes in zip(some, plain)]
        return out

    def encode(self, part: str) -> list[int]:
        return np.frombuffer(self._encoded([part])[0], self._kind).tolist()

    def known(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts, in their order."""
        values = list(map(self.get, parts))
        unseen = [k for k, value in enumerate(values) if value is None]
        if unseen:
            new = [parts[k] for k in unseen]
            ids = self._encoded(new)
            for k, value in zip(unseen, ids):
                values[k] = value
            if not self._keep(new, ids, self.LIMIT):
                self.clear()
                self._bytes = 0
                first = len(parts)
                while first and not self._keep(parts[:first], values[:first], self.LIMIT // 2):
                    first //= 2
        return values

    def _keep(self, parts: list[str], values: list[bytes], limit: int) -> bool:
        """Adds all parts but very long ones, or none if they go beyond the limit."""
        if max(map(len, parts)) >= 100:
            short = [k for k, part in enumerate(parts) if len(part) < 100]
            parts, values = [parts[k] for k in short], [values[k] for k in short]
        size = 140 * len(parts) + sum(map(len, parts)) + sum(map(len, values))
        if self._bytes + size > limit:
            return False
        self.update(zip(parts, values))
        self._bytes += size
        return True

    def __missing__(self, part: str) -> bytes:
        return self.known([part])[0]

    def texts(self, column: pa.Array, end: bytes = b"") -> pa.Array:
        """Ids of every text, and ``end`` after each."""
        split = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        parts, edges = split.values, split.offsets.to_numpy()
        taken, lengths = [], [np.zeros(0, np.int64)]
        for at in range(0, len(parts), self.SLICE):
            one = parts.slice(at, self.SLICE).dictionary_encode()
            ids = pa.array(self.known(one.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary())
            taken.append(ids.take(one.indices))
            lengths.append(pc.binary_length(taken[-1]).to_numpy())
        before = np.concatenate(([0], np.cumsum(np.concatenate(lengths), dtype=np.int64)))[edges]
        data = b"".join(memoryview(x.buffers()[2])[:int(n.sum())] for x, n in zip(taken, lengths[1:]) if n.any())
        if end:
            view = memoryview(data)
            data = b"".join(x for a, b in zip(before[:-1].tolist(), before[1:].tolist()) for x in (view[a:b], end))
            before = before + len(end) * np.arange(len(before))
        # The cast raises where ids are too many for one array.
        whole = pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(before), pa.py_buffer(data)])
        return whole.cast(pa.binary())

    def text(self, text: str) -> bytes:
        return self.texts(pa.array([text], pa.string()))[0].as_py()


@lru_cache(2)
def id_type(path: str) -> str:
    """Two bytes an id where the vocabulary allows it, else four."""
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


@lru_cache(1)
def _words(path: str, kind: str) -> _Words:
    return _Words(path, kind)


def tokenizer_file() -> str:
    """Path of the public vocabulary of lower-cased words."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def tokens(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``row, doc_id, source, doc_tokens, ids``: every text's ids and the end id, with a number per row.

    Ids are unsigned little-endian numbers of ``id_type``. A null or empty text is the end id alone. ``source`` is empty for null, else ``=`` and
    the source. The row's number is only fixed once the frame is written.
    """
    kind = id_type(tokenizer)
    end, width = np.array([end_id], kind).tobytes(), int(kind[-1])

    def encode(batches):
        words = _words(tokenizer, kind)
        for batch in batches:
            row, key, source, text = (batch.column(k) for k in range(4))
            text = pc.fill_null(text.cast(pa.string()), "")
            before = np.cumsum(pc.binary_length(text).to_numpy(), dtype=np.int64) // BYTES
            edges = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), len(text)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a < b:
                    ids = words.texts(text.slice(a, b - a), end)
                    columns = (*(c.slice(a, b - a) for c in (row, key, source)),
                               pa.array(pc.binary_length(ids).to_numpy() // width, pa.int64()), ids)
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

    return in_arrow(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source"),
        F.col("text").cast("string").alias("text")), encode, _DOCS)


def queues(docs: DataFrame, targets: Mapping[str, float] | None = None) -> DataFrame:
    """``docs(row, source, doc_tokens)`` with ``position``, the tokens before it in its source's queue, ``total``, the
    queue's tokens, ``share``, the source's part of a window, and ``phase``, where the queue starts.

    A queue is in hashed order and counted in hashed buckets, so a source that holds most tokens is
    spread over all of them. ``share`` is the source's share of all tokens, or its weight in ``targets``;
    sources not named there keep theirs.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("row", "source", "doc_tokens", F.pmod(F.xxhash64("row"), F.lit(buckets)).alias("bucket"))
    sums = keyed.groupBy("source", "bucket").agg(F.sum("doc_tokens").alias("n"))
    totals = sums.groupBy("source").agg(F.sum("n").alias("total"))
    totals = _shared(totals, targets or {}).withColumn("phase", F.pmod(F.xxhash64("source"), F.col("total")))
    places = running_before(sums, ["source"], "bucket", "n", "earlier", levels=()).drop("n").join(totals, "source")
    inside = F.sum("doc_tokens").over(Window.partitionBy("source", "bucket").orderBy("row")) - F.col("doc_tokens")
    return (keyed.withColumn("_in", inside).join(places, ["source", "bucket"])
            .withColumn("position", F.col("earlier") + F.col("_in")).drop("earlier", "_in", "bucket"))


def _shared(totals: DataFrame, targets: Mapping[str, float]) -> DataFrame:
    """Adds ``share``: the weight in ``targets``, else the part of all tokens, over the sum of both."""
    if any(weight <= 0 for weight in targets.values()):
        raise ValueError("target weights must be above zero")
    weight = F.col("total") / F.lit(totals.agg(F.sum("total")).first()[0])
    if targets:
        given = F.create_map(*(F.lit(x) for k, v in targets.items() for x in (f"={k}", float(v))))
        weight = F.coalesce(given[F.col("source")], weight)
    weighed = totals.withColumn("weight", weight)
    return weighed.withColumn("share", F.col("weight") / F.lit(weighed.agg(F.sum("weight")).first()[0])).drop("weight")


def _tail(tokens_left: int) -> list[int]:
    """Powers of two, largest first, that make up what doesn't fill a last window."""
    return [1 << b for b in range(tokens_left.bit_length() - 1, -1, -1) if tokens_left >> b & 1]


class _Places:
    """Sequence and offset of every output position: full windows, then a tail of powers of two."""

    def __init__(self, total: int, capacity: int):
        self.full, self.capacity = total // capacity, capacity
        self.tail = np.concatenate(([0], np.cumsum(_tail(total % capacity)))).astype(np.int64)

    def at(self, position: int) -> tuple[int, int, int]:
        """(sequence, offset there, tokens up to its end)."""
        window, offset = divmod(position, self.capacity)
        if window < self.full:
            return window, offset, self.capacity - offset
        k = int(np.searchsorted(self.tail, offset, "right")) - 1
        return window + k, offset - int(self.tail[k]), int(self.tail[k + 1]) - offset


def serve(pieces: list[tuple], shares: dict[str, float], deficits: dict[str, float], position: int, places: _Places,
          turn: int = TURN):
    """Deficit round robin over one partition: yields ``(row, start, length, sequence, offset)``.

    ``pieces`` are (source, row, start, length) in the order of their queues; ``deficits`` are those before the first window.
    """
    waiting: dict[str, list] = {}
    for source, *piece in reversed(pieces):
        waiting.setdefault(source, []).append(piece)
    deficit = {s: deficits[s] for s in waiting}
    while waiting:
        sequence, offset, room = places.at(position)
        # The window's tokens fall due; a partition that begins inside a window goes on with its rest.
        active = sum(shares[s] for s in waiting)
        for source in waiting:
            deficit[source] += room * shares[source] / active
        heap = [(-deficit[s], s) for s in waiting]
        heapq.heapify(heap)
        while room and heap:
            due, source = heapq.heappop(heap)
            allowed = max(int(-due), turn)
            while allowed and room and source in waiting:
                row, start, length = waiting[source][-1]
                take = min(length, allowed, room)
                # No crumbs: a rest shorter than a turn goes along where it fits.
                if length - take < turn:
                    take = min(length, room)
                yield row, start, take, sequence, offset
                deficit[source] -= take
                position, offset, room, allowed = position + take, offset + take, room - take, max(0, allowed - take)
                if take == length:
                    waiting[source].pop()
                    if not waiting[source]:
                        del waiting[source]
                else:
                    waiting[source][-1] = [row, start + take, length - take]
            if source in waiting:
                heapq.heappush(heap, (-deficit[source], source))


def schedule(queued: DataFrame, capacity: int = CAPACITY, turn: int = TURN, span: int = SPAN) -> DataFrame:
    """``row, start, length, sequence_id, offset`` of all tokens in ``queued``, as ``queues`` returns it."""
    total = queued.agg(F.sum("doc_tokens")).first()[0] or 0
    places = _Places(total, capacity)
    # A document is dealt to partitions in cuts of the tokens that a window gives its source.
    quantum = F.greatest(F.lit(turn), F.floor(F.col("share") * capacity)).cast("long")
    cuts = queued.withColumn("quantum", quantum).withColumn(
        "start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("doc_tokens") - 1, F.col("quantum"))))
    cuts = cuts.withColumn("length", F.least("quantum", F.col("doc_tokens") - F.col("start"))).withColumn(
        "at", F.pmod(F.col("position") + F.col("start") + F.col("phase"), F.col("total")))
    parted = kept(cuts.select(
        F.floor(F.col("at") / F.col("share") / span).cast("long").alias("part"), "source", "share", "at", "row", "start", "length"), "cuts")
    sums = kept(parted.groupBy("part", "source", "share").agg(F.sum("length").alias("n")), "shares")
    served = running_before(sums, ["source"], "part", "n", "served", levels=(16,))
    begun = running_before(sums.groupBy("part").agg(F.sum("n").alias("n")).withColumn("_", F.lit(0)), ["_"], "part", "n", "begun",
                           levels=(32, 16)).select("part", "begun")
    # Due until the partition begins, less what the partitions before it serve.
    state = served.join(begun, "part").select(
        "part", "source", "begun", (F.col("part") * span * F.col("share") - F.col("served")).alias("deficit"))
    rows = parted.join(state, ["part", "source"])

    def run(table: pa.Table):
        part = table["part"].to_numpy()
        edges = np.concatenate((np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))), [len(part)]))
        for a, b in zip(edges[:-1], edges[1:]):
            one = table.slice(a, b - a)
            source, row, start, length, share, deficit = (one[c].to_pylist() for c in (
                "source", "row", "start", "length", "share", "deficit"))
            out = _joined(serve(list(zip(source, row, start, length)), dict(zip(source, share)), dict(zip(source, deficit)),
                                one["begun"][0].as_py(), places, turn))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_CUTS_ARROW)

    return in_groups(rows, ["part"], run, _CUTS, ["source", "at", "row", "start"])


def _joined(pieces):
    """Neighbouring pieces of a document and sequence as one."""
    out: list[list[int]] = []
    for row, start, length, sequence, offset in pieces:
        last = out[-1] if out else None
        if last and last[0] == row and last[3] == sequence and last[1] + last[2] == start:
            last[2] += length
        else:
            out.append([row, start, length, sequence, offset])
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, targets: Mapping[str, float] | None = None,
         tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents in sequences that mix the sources in proportion.

    Returns ``doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset``. Sequences hold ``capacity`` tokens without
    a gap; what is left at the end makes sequences of powers of two. By default each sequence mixes the sources as the corpus
    does; with ``targets`` (weights by source) as given there until a queue runs out, whose part the others
    then take by their deficits. Null sources are a queue of their own. Null and empty texts are the end id alone, repeated rows are packed
    each for itself, ties in a queue fall by row, a long text is cut over as many sequences as it takes, other columns are not
    read, and an empty table gives an empty result. The order of pieces may differ from run to run.
    """
    tokenizer = tokenizer or tokenizer_file()
    kind = id_type(tokenizer)
    found = kept(tokens(docs, tokenizer, end_id), "tokens")
    queued = kept(queues(found.drop("ids", "doc_id"), targets), "queues")
    placed = schedule(queued, capacity)
    width = int(kind[-1])
    own = F.substring("ids", (width * F.col("start") + 1).cast("int"), (width * F.col("length")).cast("int"))
    names = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = found.join(placed, "row").select(
        "doc_id", F.when(F.col("source") != "", F.expr("substring(source, 2)")).alias("source"), "start", "length",
        own.alias("ids"), "doc_tokens", "sequence_id", "offset")

    def sums(batches):
        for batch in batches:
            codes = [zlib.crc32(np.frombuffer(x, kind).astype("<u4")) for x in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes, pa.int64()) if k == 4 else batch.column(k) for k in range(8)], names)

    return in_arrow(rows, sums, "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
                                "sequence_id long, offset long")
