"""Line dedup by pairwise alignment.

Overlapping documents are found through shared rare lines: each holder of a line that few documents have
is paired with all earlier ones. Lines that more documents have would make too many pairs; their
holders are paired with the earliest alone, one pair per line and document, however many share it.
Pairs that this misses are found exactly: every shortest run of neighbouring lines that has enough
words is a key, and its holders are paired with the earliest of them. Finding deletes nothing: each pair
is aligned by patience diff, whose elements are these runs, and the aligned common blocks go from the
later document. What one alignment leaves of a pair is aligned again, so blocks that changed their order go too.
Documents are ordered by doc_id, nulls last.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterloom.llm.common import bound, free_name, in_arrow, kept, row_key

MIN_WORDS, RARE = 20, 6
_SALTS = 64


def _chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of (a, b), sorted by a, in which b grows: patience sorting."""
    tops, piles, before = [], [], {}
    for k, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        if at == len(tops):
            tops.append(b)
            piles.append(k)
        else:
            tops[at], piles[at] = b, k
        before[k] = piles[at - 1] if at else None
    out, k = [], piles[-1] if piles else None
    while k is not None:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places of equal elements of ``a`` and ``b``, growing in both.

    Equal ends are aligned first, then elements that are unique in both ranges, along their
    longest chain, then the same between these. Where no element is unique, equal ones are
    paired by number of occurrence.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[k]: k for k in range(b0, b1) if in_b[b[k]] == 1}
        anchors = _chain([(k, place[a[k]]) for k in range(a0, a1) if in_a[a[k]] == 1 and a[k] in place])
        if anchors:
            out += anchors
            ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            todo += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(ends, ends[1:])]
            continue
        seen, numbered = Counter(), {}
        for k in range(b0, b1):
            numbered[b[k], seen[b[k]]] = k
            seen[b[k]] += 1
        seen.clear()
        pairs = []
        for k in range(a0, a1):
            if (at := numbered.get((a[k], seen[a[k]]))) is not None:
                pairs.append((k, at))
            seen[a[k]] += 1
        out += _chain(pairs)
    return sorted(out)


_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


def shortest_runs(doc: np.ndarray, i: np.ndarray, h: np.ndarray, w: np.ndarray, min_words: int):
    """Runs of lines with neighbouring numbers ``i`` in one document that have ``min_words`` words but
    would not without their last line, or without their first: places of their first and last line, and a 64-bit key.

    The lines are sorted by ``doc`` and ``i``. Every line of a longer run lies in one of these inside it: in the one
    that ends there, or, near the run's begin, in the one that begins with the run.
    """
    n = len(i)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    part = np.cumsum(np.concatenate([[0], ((doc[1:] != doc[:-1]) | (i[1:] != i[:-1] + 1)).astype(np.int64)]))
    total = np.concatenate([[0], np.cumsum(w, dtype=np.int64)])
    at = np.arange(n)
    ends = np.searchsorted(total, total[:-1] + min_words) - 1  # the least line up to which there are enough
    begins = np.searchsorted(total, total[1:] - min_words, "right") - 1  # the last one from which there are
    forward, backward = (ends < n), (begins >= 0)
    first = np.concatenate([at[forward], begins[backward]])
    last = np.concatenate([ends[forward], at[backward]])
    same = part[first] == part[last]
    found = np.unique(np.stack([first[same], last[same]], axis=1), axis=0)
    first, last = found[:, 0], found[:, 1]
    # A polynomial of the lines' hashes, by prefix sums, with the place in the batch divided out.
    power = np.full(n, _BASE, np.uint64)
    power[0] = 1
    back = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    back[0] = 1
    power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h.astype(np.int64).view(np.uint64) * power, dtype=np.uint64)])
    return first, last, ((sums[last + 1] - sums[first]) * back[first]).view(np.int64)


def _keyed_runs(lines: list[dict], min_words: int) -> list[tuple[int, int, int]]:
    """``(key, first, last)`` of a document's shortest runs, in their order; places in ``lines``."""
    i, h, w = (np.array([s[c] for s in lines], np.int64) for c in ("i", "h", "w"))
    first, last, key = shortest_runs(np.zeros(len(lines), np.int64), i, h, w, min_words)
    return list(zip(key.tolist(), first.tolist(), last.tolist()))


def common_blocks(earlier: list[dict], later: list[dict], min_words: int) -> list[int]:
    """Line numbers of ``later`` inside aligned blocks of ``min_words`` or more.

    Lines are ``{i, h, w}``: number among the lines with words, hash, words; ``g``, a second hash, may follow.
    The shortest runs of both are aligned, then those of ``later`` that found no partner again, until none does. A block is
    unbroken in both documents, and its lines agree in all hashes.
    """
    a, left = _keyed_runs(earlier, min_words), _keyed_runs(later, min_words)
    common = {k for k, _, _ in a} & {k for k, _, _ in left}
    a, left = [r for r in a if r[0] in common], [r for r in left if r[0] in common]
    gone: set[int] = set()
    while left:
        aligned = patience([k for k, _, _ in a], [k for k, _, _ in left])
        for x, y in aligned:
            (_, s, e), (_, u, v) = a[x], left[y]
            if e - s == v - u and all(earlier[s + k]["h"] == later[u + k]["h"] and earlier[s + k].get("g") == later[u + k].get("g")
                                      for k in range(v - u + 1)):
                gone.update(later[k]["i"] for k in range(u, v + 1))
        done = {y for _, y in aligned}
        left = [r for y, r in enumerate(left) if y not in done]
    return sorted(gone)


def _run_rows(sequences: DataFrame, min_words: int) -> DataFrame:
    """``at, key, i, j`` of the shortest runs of ``at, seq`` rows: a key, and the numbers of its first and last line."""
    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            lines, sizes = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(batch.num_rows), sizes)
            i, h, w = (lines.field(c).to_numpy(zero_copy_only=False) for c in ("i", "h", "w"))
            first, last, key = shortest_runs(doc, i, h, w, min_words)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc[first])), pa.array(key), pa.array(i[first], pa.int32()),
                                              pa.array(i[last], pa.int32())], ["at", "key", "i", "j"])

    return in_arrow(sequences.select("at", "seq"), run, f"at {sequences.schema['at'].dataType.simpleString()}, key long, i int, j int")


def _numbered(text):
    """Lines with words, and all lines."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``node, gone, sources`` of the documents that lose lines.

    ``node`` is the row's key, ``gone`` the numbers (from 0, among lines with
    words) of the lines to delete, ``sources`` the ids of the earlier documents that hold them.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    one = docs.select(row_key().alias("node"), F.col("doc_id").cast("long").alias("doc_id"),
                      F.transform(_numbered(text), lambda x: F.struct(
                          F.xxhash64(x).alias("h"), F.xxhash64(F.lit(7), x).alias("g"), F.size(F.array_remove(F.split(x, r"[\x20\x09-\x0D]+"), "")).alias("w"))).alias("l"))
    lines = kept(one.select("node", "doc_id", F.posexplode("l").alias("i", "l")).select(
        "node", F.struct(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "node").alias("at"),
        "i", F.col("l.h").alias("h"), F.col("l.g").alias("g"), F.col("l.w").alias("w")), "lines")
    shared_lines = kept(lines.groupBy("h").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n"))
                        .where("first <> last").select("h", "first", "n"), "shared_lines")
    shared = kept(lines.join(shared_lines, "h"), "shared")
    # At most RARE holders each: a line that is common by repetition inside its documents counts as common.
    holders = (shared.where(F.col("n") <= RARE).groupBy("h").agg(F.collect_set("at").alias("holders")))
    rare = (shared.where(F.col("n") <= RARE).join(holders, "h")
            .select("at", "i", "w", F.explode(F.filter("holders", lambda x: x < F.col("at"))).alias("owner")))
    common = shared.where((F.col("n") > RARE) & (F.col("at") > F.col("first"))).select("at", "i", "w", F.col("first").alias("owner"))
    by_line = (rare.unionByName(common).groupBy("at", "owner").agg(F.sum("w").alias("words"))
               .where(F.col("words") >= min_words).select("at", "owner"))
    # A repeated row has the same node, and so the same lines: once each.
    sequences = shared.groupBy("at").agg(F.sort_array(F.collect_set(F.struct("i", "h", "w", "g"))).alias("seq"))
    sequences = kept(sequences.where(F.aggregate("seq", F.lit(0), lambda a, x: a + x["w"]) >= min_words)
                     .select(F.col("at.node").alias("node"), "at", "seq"), "sequences")
    runs = kept(_run_rows(sequences, min_words), "runs")
    earliest = runs.groupBy("key").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first <> last").select("key", "first")
    by_run = runs.join(earliest, "key").where("at > first").select("at", F.col("first").alias("owner"))
    pairs = kept(by_line.unionByName(by_run).distinct().select(
        F.col("at.node").alias("node"), F.col("owner.node").alias("earlier"),
        F.when(~F.col("owner.last"), F.col("owner.doc_id")).alias("source"),
        F.pmod(F.xxhash64("at.node"), F.lit(_SALTS)).alias("salt")), "pairs")
    # A document that most others repeat is copied once per salt that its pairs have, so that they meet it in as many tasks.
    copies = (pairs.select("earlier", "salt").distinct()
              .join(sequences.select(F.col("node").alias("earlier"), F.col("seq").alias("earlier_seq")), "earlier"))
    both = (pairs.join(sequences.select("node", F.col("seq").alias("later_seq")), "node").join(copies, ["earlier", "salt"])
            .select("node", "source", "earlier_seq", "later_seq"))
    schema = pa.schema([("node", pa.string()), ("source", pa.int64()), ("gone", pa.list_(pa.int32()))])

    def align(batches):
        for batch in batches:
            nodes, sources, gone = [], [], []
            for k in range(batch.num_rows):
                found = common_blocks(batch.column(2)[k].as_py(), batch.column(3)[k].as_py(), min_words)
                if found:
                    nodes.append(batch.column(0)[k].as_py())
                    sources.append(batch.column(1)[k].as_py())
                    gone.append(found)
            yield pa.RecordBatch.from_pydict({"node": nodes, "source": sources, "gone": gone}, schema=schema)

    found = in_arrow(both, align, "node string, source long, gone array<int>")
    return found.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_set("gone"))).alias("gone"),
                                     F.sort_array(F.collect_set("source")).alias("sources"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with their columns, ``text`` cut, and a struct column ``_lines`` (or
    a free name; it is the last): ``n_lines``, ``n_gone``, ``words_gone``, ``sources``.

    Lines end at ``\\n``; lines without words are never compared and always stay, and lines compare
    whole, by two hashes of 64 bits. Very long texts take time in proportion to their lines, and once more for each alignment
    that blocks in changed order need. A text that loses nothing stays as it is, null included. Rows that repeat another's doc_id
    and text are one document and are treated alike; of equal ids with different texts,
    either may be the later. An empty table gives an empty result.
    """
    name, node = free_name(docs, "_lines"), free_name(docs, "_node")
    gone = kept(deletions(docs, min_words), "gone").select(F.col("node").alias(node), "gone", "sources")
    keyed = docs.withColumn(node, row_key())
    own = [F.col(f"d.`{c}`") for c in docs.columns]
    # The same plan at every size: never a broadcast, which only a small corpus would get.
    joined = keyed.alias("d").join(gone.hint("merge").alias("g"), node, "left")
    words = lambda x: F.size(F.array_remove(F.split(x, r"[\x20\x09-\x0D]+"), ""))

    def cut(lines):
        """What stays and the words that go; places in sets, so that the work grows with the lines only."""
        places = F.sequence(F.lit(0), F.size(lines) - 1)
        with_words = F.filter(places, lambda p: F.get(lines, p).rlike(r"[^\x20\x09-\x0D]"))
        return bound(bound(with_words, lambda own: F.transform(F.col("g.gone"), lambda k: F.get(own, k))), lambda out: F.struct(
            F.transform(F.array_except(places, out), lambda p: F.get(lines, p)).alias("out"),
            F.aggregate(out, F.lit(0), lambda a, p: a + words(F.get(lines, p))).alias("w")))

    done = joined.select(*own, F.when(F.col("g.gone").isNotNull(), bound(F.split("d.text", "\n"), cut)).alias(name), F.struct(
        F.size(_numbered(text_of("d"))).alias("n_lines"), F.coalesce(F.size("g.gone"), F.lit(0)).alias("n_gone"),
        F.coalesce("g.sources", F.array().cast("array<long>")).alias("sources")).alias(node))
    state = F.col(name)
    new = F.when(state.isNotNull(), F.array_join(state["out"], "\n")).otherwise(F.col("text"))
    return done.select(*((new.alias(c) if c == "text" else F.col(f"`{c}`")) for c in docs.columns),
                       F.col(node).withField("words_gone", F.coalesce(state["w"], F.lit(0))).alias(name))


def text_of(alias: str):
    return F.coalesce(F.col(f"{alias}.text").cast("string"), F.lit(""))


def cleaned(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` after line dedup, with their columns; ``n_chars``, if there, follows the text.

    A document of which no word is left goes; one that had none stays.
    """
    done = dedup_lines(docs, min_words)
    state = F.col(done.columns[-1])
    left = done.where(F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]") | (state["n_gone"] == 0))
    return left.select(*(
        F.when(state["n_gone"] > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
        if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))
