"""Benchmark decontamination through a stored, distributed positional inverted index.

The index holds, for each segment of documents, the positions of every word that a
test item uses, in one sorted list per term. A test window is found by intersecting
its terms' lists, shifted by their offsets in the window, from the term that is
rarest in the whole corpus. Segments are built and searched where they lie: neither step
shuffles text or postings.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterloom.llm.common import free_name, in_arrow, kept, row_key, texts

WINDOW, SLOP, SEGMENT_BYTES, BLOCK_BYTES = 10, 5, 6_000_000, 8_000_000

_WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_INDEX = ("segment string, doc_ids array<string>, n_words array<int>, starts array<int>, "
          "terms array<string>, counts array<int>, positions binary")
_INDEX_ARROW = pa.schema([
    ("segment", pa.string()), ("doc_ids", pa.list_(pa.string())), ("n_words", pa.list_(pa.int32())),
    ("starts", pa.list_(pa.int32())), ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())),
    ("positions", pa.binary())])
_SPANS = "array<struct<first:int,last:int>>"
_FOUND = (f"segment string, ordinal int, doc_id string, n_words long, spans {_SPANS}, "
          "items array<string>, near_items array<string>")
_FOUND_ARROW = pa.schema([
    ("segment", pa.string()), ("ordinal", pa.int32()), ("doc_id", pa.string()), ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
    ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string()))])


def words(text: str | None) -> list[str]:
    """Lower-cases A-Z only; words are runs of digits, a-z and anything beyond ASCII."""
    return _WORDS.findall((text or "").translate(_LOWER) if text and not text.islower() else text or "")


@dataclass
class Queries:
    """Distinct windows of a block of test items."""

    windows: list[tuple[str, ...]]
    items: list[list[str]]

    @classmethod
    def of(cls, rows, size: int) -> Queries:
        found: dict[tuple[str, ...], set[str]] = {}
        for item, text in rows:
            own = words(text)
            for k in range(max(1, len(own) - size + 1) if own else 0):
                found.setdefault(tuple(own[k:k + size]), set()).add(str(item))
        return cls(list(found), [sorted(x) for x in found.values()])


def query_blocks(benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES):
    """The test items in blocks of about ``block_bytes`` of text, one at a time on the driver.

    A search ships a block to every task, so its size is bounded whatever the benchmark's.
    """
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k)
        yield Queries.of([(r[0], r[1]) for r in part.collect()], size)


def build_index(docs: DataFrame, terms: set[str], segment_bytes: int = SEGMENT_BYTES,
                gap: int = WINDOW + SLOP) -> DataFrame:
    """One row per segment: its documents, and postings of ``terms`` sorted by term and position.

    Positions count words through the segment, with ``gap`` unused ones after each
    document so that no match spans two. Words outside ``terms`` take a position but
    no posting: no test item can ask for them.
    """
    names = sorted(terms)

    def build(batches):
        number = {w: i for i, w in enumerate(names)}
        get = number.get

        def segment(keys, ids, lengths):
            starts = np.zeros(len(lengths), np.int64)
            np.cumsum(np.array(lengths[:-1], np.int64) + gap, out=starts[1:])
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            where = np.arange(len(flat)) + np.repeat(np.arange(len(lengths)) * gap, lengths)
            hit = flat >= 0
            flat, where = flat[hit], where[hit]
            order = np.argsort(flat, kind="stable")
            present, counts = np.unique(flat, return_counts=True)
            return pa.RecordBatch.from_pydict({
                "segment": [uuid.uuid4().hex], "doc_ids": [keys], "n_words": [lengths],
                "starts": [starts.astype(np.int32)], "terms": [[names[i] for i in present]],
                "counts": [counts.astype(np.int32)],
                "positions": [where[order].astype("<u4").tobytes()]}, schema=_INDEX_ARROW)

        keys, ids, lengths, size = [], [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = words(text.as_py())
                keys.append(key)
                lengths.append(len(own))
                ids.append(np.array([get(w, -1) for w in own], np.int32))
                size += 4 * len(own) + 16
                if size > segment_bytes:
                    yield segment(keys, ids, lengths)
                    keys, ids, lengths, size = [], [], [], 0
        if keys:
            yield segment(keys, ids, lengths)

    return in_arrow(texts(docs, "string"), build, _INDEX)


def term_counts(index: DataFrame) -> DataFrame:
    """Occurrences of each indexed term in the whole corpus."""
    return (index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
            .groupBy("t.terms").agg(F.sum("t.counts").alias("n")).withColumnRenamed("terms", "term"))


def _near(lists, reach: int):
    """Positions of the rarest list that have every other term within ``reach``."""
    at = lists[0]
    for other in lists[1:]:
        if not len(at):
            break
        k = np.searchsorted(other, at - reach)
        at = at[(k < len(other)) & (other[np.minimum(k, len(other) - 1)] <= at + reach)]
    return at


def search(index: DataFrame, queries: Queries, frequency: dict[str, int], slop: int = SLOP) -> DataFrame:
    """Per document: merged word spans of exact window occurrences, the items they
    belong to, and the items with a window all of whose words lie within
    ``len(window) - 1 + slop`` words of an occurrence of its rarest word."""
    ordered = [sorted(range(len(w)), key=lambda k: (frequency.get(w[k], 0), k)) for w in queries.windows]

    def find(batches):
        terms = sorted({t for w in queries.windows for t in w})
        number = {t: i for i, t in enumerate(terms)}
        lengths = np.array([len(w) for w in queries.windows], np.int64)
        widest = int(lengths.max()) if len(lengths) else 1
        asked = np.full((len(queries.windows), widest), len(terms), np.int64)
        for k, w in enumerate(queries.windows):
            asked[k, :len(w)] = [number[t] for t in w]
        for batch in batches:
            for row in batch.to_pylist():
                positions = np.frombuffer(row["positions"], "<u4").astype(np.int64)
                ends = np.cumsum(np.array(row["counts"], np.int64)) if row["counts"] else np.zeros(0, np.int64)
                lists: dict[int, np.ndarray] = {}
                there = np.zeros(len(terms) + 1, bool)
                there[len(terms)] = True
                for t, n, end in zip(row["terms"], row["counts"], ends):
                    if t in number:
                        lists[number[t]] = positions[end - n:end]
                        there[number[t]] = True
                starts, n_words = np.array(row["starts"], np.int64), np.array(row["n_words"], np.int64)
                total = int(starts[-1] + n_words[-1]) + widest + 1
                edge = np.zeros(total + 1, np.int32)
                exact = [set() for _ in starts]
                near = [set() for _ in starts]
                for k in np.flatnonzero(there[asked].all(axis=1)):
                    order, ask = ordered[k], asked[k]
                    at = _near([lists[ask[o]] for o in order], int(lengths[k]) - 1 + slop)
                    if not len(at):
                        continue
                    for d in np.unique(np.searchsorted(starts, at, "right") - 1):
                        near[d].update(queries.items[k])
                    begin = at - order[0]
                    for o in order[1:]:
                        if not len(begin):
                            break
                        there_at = lists[ask[o]]
                        j = np.minimum(np.searchsorted(there_at, begin + o), len(there_at) - 1)
                        begin = begin[there_at[j] == begin + o]
                    if len(begin):
                        np.add.at(edge, begin, 1)
                        np.add.at(edge, begin + lengths[k], -1)
                        for d in np.unique(np.searchsorted(starts, begin, "right") - 1):
                            exact[d].update(queries.items[k])
                hit = np.diff(np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8), [0]]))
                first, last = np.flatnonzero(hit == 1), np.flatnonzero(hit == -1)
                owner = np.searchsorted(starts, first, "right") - 1
                spans = [[] for _ in starts]
                for d, a, b in zip(owner, first, last):
                    spans[d].append({"first": int(a - starts[d]), "last": int(b - starts[d])})
                n = len(starts)
                yield pa.RecordBatch.from_pydict({
                    "segment": [row["segment"]] * n, "ordinal": np.arange(n, dtype=np.int32),
                    "doc_id": row["doc_ids"], "n_words": n_words, "spans": spans,
                    "items": [sorted(x) for x in exact], "near_items": [sorted(x) for x in near]},
                    schema=_FOUND_ARROW)

    return in_arrow(index, find, _FOUND)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, slop: int = SLOP,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, spans, n_hit, items, near_items``.

    ``spans`` are half-open ranges of word numbers inside an occurrence of a window of
    ``size`` consecutive item words (an item of fewer words is one window). Null
    and empty texts have no words and no spans; repeated rows are repeated; null item
    texts and ids ask nothing; without items nothing is hit. The benchmark may have any size: it is
    searched in blocks, whose spans are joined per document.
    """
    blocks = list(query_blocks(benchmark, size, block_bytes))
    terms = {t for q in blocks for w in q.windows for t in w}
    index = kept(build_index(docs, terms, gap=size + slop), "index")
    frequency = {r["term"]: r["n"] for r in term_counts(index).collect()}
    found = None
    for block in blocks:
        part = search(index, block, frequency, slop)
        found = part if found is None else found.unionByName(part)
    if len(blocks) > 1:
        found = found.groupBy("segment", "ordinal").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            *(F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("items", "near_items")))
    # Spans of several blocks may overlap: each counts from where those before it end.
    covered = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["last"] - F.greatest(s["first"], a["end"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], s["last"]).alias("end")), lambda a: a["n"].cast("long"))
    return found.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_words", "spans", covered.alias("n_hit"),
                        F.array_sort("items").alias("items"), F.array_sort("near_items").alias("near_items"))


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with their columns."""
    key = free_name(docs, "_key")
    keyed = docs.withColumn(key, row_key())
    found = contamination(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark, size)
    dirty = kept(found.where("n_hit > 0").select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return keyed.join(dirty, key, "left_anti").drop(key)
