"""A Merkle manifest of a dataset: leaf coordinates by rank in doc_id bitmaps, levels reduced in slot arrays.

A document's place within its language is the rank of its id. Ids are kept as compressed bitmaps: containers of
65,536 ids, of which only the 64-bit words with a bit set are stored, next to a directory of the rows
before each word; a second directory, in levels of at most 65,536 entries, holds the rows before each container. Tasks
build containers of what they see, these are merged by OR, and a rank is a look-up and a population count: no
sort of the leaves. Leaves then go to slot arrays keyed by (language, place div 4096); each array is twelve levels of
the tree, reduced in one go. The arrays' roots are the next round's leaves.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterloom.llm.common import in_arrow, kept
from rosterloom.llm.grouped import in_groups, running_before

LEVELS = 12  # of the tree in a slot array
_CONTAINER = 16
_NO_ID = -(1 << 47) - 1  # the container before all others: a null id
_BUFFER = 200_000

_PARTIAL = pa.schema([("grp", pa.string()), ("hi", pa.int64()), ("at", pa.binary()), ("words", pa.binary()), ("many", pa.binary())])
_SLOT_SCHEMA = ("grp string, block long, n int, digests binary, ids binary, no_id binary, changed_at binary, "
                "changed binary, root binary")
_SLOT_ARROW = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("n", pa.int32()), *(
    (c, pa.binary()) for c in ("digests", "ids", "no_id", "changed_at", "changed", "root"))])
_PATH_SCHEMA = "grp string, block long, steps string, siblings binary, subroot string, root string"
_PATH_ARROW = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("steps", pa.string()), ("siblings", pa.binary()),
                         ("subroot", pa.string()), ("root", pa.string())])
_PROOF_SCHEMA = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                 "verified boolean")
_PROOF_ARROW = pa.schema([("doc_id", pa.int64()), *((c, pa.string()) for c in (
    "leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())])


def _field(value: Column) -> Column:
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Rows ``grp, doc_id, leaf, changed, copies``: distinct leaves, each with how many rows have it.

    ``grp`` is empty for a null ``lang``, else ``=`` and the language. ``leaf`` hashes ``doc_id, source, lang, n_chars, text``, each with
    its length; other columns are not read. ``changed`` is the leaf with one added to ``n_chars`` where ``tampered`` holds
    and ``n_chars`` is not null.
    """
    number = F.col("n_chars").cast("decimal(20,0)")
    text = [F.col(c).cast("string") for c in ("doc_id", "source", "lang")]

    def digest(n_chars: Column) -> Column:
        fields = (*text, n_chars.cast("string"), F.col("text").cast("string"))
        return F.unhex(F.sha2(F.concat(*map(_field, fields)), 256))

    changed = F.when((F.lit(False) if tampered is None else tampered) & number.isNotNull(), digest(number + 1))
    return docs.select(
        F.coalesce(F.concat(F.lit("="), text[2]), F.lit("")).alias("grp"), F.col("doc_id").cast("long").alias("doc_id"),
        digest(number).alias("leaf"), changed.alias("changed")).groupBy("grp", "doc_id", "leaf", "changed").agg(
        F.count("*").alias("copies"))


def _containers(rows: pa.Table):
    """Partial containers of some rows ``grp, hi, lo, copies``."""
    names = rows["grp"].combine_chunks().dictionary_encode()
    hi, lo, copies = (rows[c].to_numpy() for c in ("hi", "lo", "copies"))
    code = names.indices.to_numpy()
    order = np.lexsort((lo, hi, code))
    code, hi, lo, copies = code[order], hi[order], lo[order], copies[order]
    new = np.concatenate(([True], (code[1:] != code[:-1]) | (hi[1:] != hi[:-1])))
    edges = np.concatenate((np.flatnonzero(new), [len(lo)]))
    out = []
    for a, b in zip(edges[:-1], edges[1:]):
        ids, first = np.unique(lo[a:b], return_index=True)
        times = np.add.reduceat(copies[a:b], first)
        word = ids >> 6
        at, start = np.unique(word, return_index=True)
        words = np.bitwise_or.reduceat(np.uint64(1) << (ids & 63).astype(np.uint64), start)
        more = times > 1
        many = np.stack([ids[more], times[more] - 1], axis=1)
        out.append((names.dictionary[int(code[a])].as_py(), int(hi[a]), at.astype("<i2").tobytes(),
                    words.astype("<u8").tobytes(), many.astype("<i8").tobytes()))
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PARTIAL)], schema=_PARTIAL)


def _merged(table: pa.Table):
    """Whole containers: words by OR, with the rows before each word."""
    held: dict[tuple[str, int], list] = defaultdict(list)
    for grp, hi, *parts in zip(*(table[c].to_pylist() for c in ("grp", "hi", "at", "words", "many"))):
        held[grp, hi].append(parts)
    rows = []
    for (grp, hi), parts in held.items():
        bits = np.zeros(1 << _CONTAINER - 6, np.uint64)
        more: dict[int, int] = defaultdict(int)
        for at, words, many in parts:
            at, words = np.frombuffer(at, "<i2"), np.frombuffer(words, "<u8")
            again = bits[at] & words
            for k in np.flatnonzero(again):  # an id that another task saw too
                for bit in range(64):
                    if int(again[k]) >> bit & 1:
                        more[int(at[k]) * 64 + bit] += 1
            bits[at] |= words
            for low, n in np.frombuffer(many, "<i8").reshape(-1, 2).tolist():
                more[low] += n
        at = np.flatnonzero(bits)
        words = bits[at]
        counts = np.bitwise_count(words).astype(np.int64)
        of_word: dict[int, list] = defaultdict(list)
        for low in sorted(more):
            of_word[low >> 6].append({"bit": low & 63, "more": more[low]})
        if more:
            counts += np.array([sum(x["more"] for x in of_word.get(w, ())) for w in at.tolist()])
        rows.append({"grp": grp, "hi": hi, "at": at.tolist(), "words": words.view(np.int64).tolist(),
                     "before": (np.cumsum(counts) - counts).tolist(),
                     "many": [of_word.get(w, []) for w in at.tolist()] if more else None, "total": int(counts.sum())})
        if len(rows) >= 200:
            yield pa.RecordBatch.from_pylist(rows, schema=_INDEX_ARROW)
            rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_INDEX_ARROW)


_INDEX_SCHEMA = ("grp string, hi long, at array<int>, words array<bigint>, before array<bigint>, "
                 "many array<array<struct<bit: int, more: bigint>>>, total bigint")
_INDEX_ARROW = pa.schema([
    ("grp", pa.string()), ("hi", pa.int64()), ("at", pa.list_(pa.int32())), ("words", pa.list_(pa.int64())),
    ("before", pa.list_(pa.int64())),
    ("many", pa.list_(pa.list_(pa.struct([("bit", pa.int32()), ("more", pa.int64())])))), ("total", pa.int64())])


def _container() -> list[Column]:
    """``hi, lo``: an id's container and its number there."""
    return [F.coalesce(F.shiftright("doc_id", _CONTAINER), F.lit(_NO_ID)).alias("hi"),
            F.coalesce(F.col("doc_id").bitwiseAND((1 << _CONTAINER) - 1), F.lit(0)).cast("long").alias("lo")]



def bitmap_index(rows: DataFrame) -> DataFrame:
    """Compressed bitmaps of ``rows(grp, doc_id, copies)``: one row per container, with the rows ``base`` before it.

    An id counts once in the bitmap; what it has beyond one row is kept beside its word (``many``).
    """
    def seen(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= _BUFFER:
                yield from _containers(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield from _containers(pa.Table.from_batches(held))

    parts = in_arrow(rows.select("grp", *_container(), "copies"), seen,
                     "grp string, hi long, at binary, words binary, many binary")
    index = kept(in_groups(parts, ["grp", "hi"], _merged, _INDEX_SCHEMA, size=2_000), "bitmaps")
    base = running_before(index.select("grp", "hi", "total"), ["grp"], "hi", "total", "base", levels=(32, 16))
    return kept(index.drop("total").join(base.drop("total"), ["grp", "hi"]), "bitmaps")


def coordinates(rows: DataFrame) -> DataFrame:
    """``rows`` with ``place``: of the row's first copy among the rows of its group, by id, then leaf.

    Null ids come first. Rows of one id and different leaves are ordered by leaf; such an id, however many
    rows it has, is counted in 65,536 cells of its leaves' first bits.
    """
    index = bitmap_index(rows)
    word = F.shiftright("lo", 6).cast("int")
    bit = F.col("lo").bitwiseAND(63).cast("int")
    found = rows.select("*", *_container()).join(index, ["grp", "hi"]).withColumn(
        "_k", F.array_position("at", word).cast("int") - 1)
    in_word = lambda test: F.aggregate(F.filter(F.get("many", F.col("_k")), test), F.lit(0).cast("long"),
                                       lambda s, x: s + x["more"])
    below = F.bit_count(F.get("words", F.col("_k")).bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit))))
    ranked = kept(found.select(
        *rows.columns, "hi", "lo",
        (F.col("base") + F.get("before", F.col("_k")) + below + F.coalesce(in_word(lambda x: x["bit"] < bit), F.lit(0))).alias("place"),
        (1 + F.coalesce(in_word(lambda x: x["bit"] == bit), F.lit(0))).alias("of_id")), "ranks")
    alone = ranked.where("of_id = copies")
    tied = ranked.where("of_id <> copies").withColumn("cell", F.conv(F.substring(F.hex("leaf"), 1, 4), 16, 10).cast("long"))
    one = ["grp", "hi", "lo"]
    cells = running_before(tied.groupBy(*one, "cell").agg(F.sum("copies").alias("n")), one, "cell", "n", "earlier", levels=())
    inside = F.sum("copies").over(Window.partitionBy(*one, "cell").orderBy("leaf")) - F.col("copies")
    tied = tied.withColumn("_in", inside).join(cells.drop("n"), [*one, "cell"]).withColumn(
        "place", F.col("place") + F.col("earlier") + F.col("_in"))
    names = [*rows.columns, "place"]
    return alone.select(*names).unionByName(tied.select(*names))


def _h(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def _levels(hexes: list[bytes], block: int, levels: int) -> list[list[bytes]]:
    """All levels of a slot array; one that isn't a group's only array is reduced ``levels`` times."""
    out = [hexes]
    while len(out[-1]) > 1 or (block and len(out) <= levels):
        last = out[-1]
        out.append([_h(*last[k:k + 2]) for k in range(0, len(last), 2)])
    return out


def _hexes(digests: bytes) -> list[bytes]:
    whole = digests.hex().encode()
    return [whole[k:k + 64] for k in range(0, len(whole), 64)]


def _filled(table: pa.Table, levels: int):
    """One row per slot array, reduced to its root."""
    arrays: dict[tuple[str, int], list] = defaultdict(list)
    for grp, block, *cell in zip(*(table[c].to_pylist() for c in (
            "grp", "block", "slot", "times", "digest", "doc_id", "changed"))):
        arrays[grp, block].append(cell)
    rows = []
    for (grp, block), cells in arrays.items():
        n = sum(c[1] for c in cells)
        digests, ids = np.empty((n, 32), np.uint8), np.zeros(n, "<i8")
        no_id, changed = [], {}
        for slot, times, digest, key, other in cells:
            digests[slot:slot + times] = np.frombuffer(digest, np.uint8)
            if key is None:
                no_id.extend(range(slot, slot + times))
            else:
                ids[slot:slot + times] = key
            if other is not None:
                changed.update(dict.fromkeys(range(slot, slot + times), other))
        data = digests.tobytes()
        root = _levels(_hexes(data), block, levels)[-1][0]
        rows.append((grp, block, n, data, ids.tobytes(), np.array(no_id, "<i2").tobytes(),
                     np.array(list(changed), "<i2").tobytes(), b"".join(changed.values()), bytes.fromhex(root.decode())))
        if len(rows) >= 100:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SLOT_ARROW)], schema=_SLOT_ARROW)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SLOT_ARROW)], schema=_SLOT_ARROW)


def _slot_arrays(nodes: DataFrame, levels: int) -> DataFrame:
    """Slot arrays of ``nodes(grp, place, copies, digest, doc_id, changed)``; copies fill neighbouring slots."""
    slots, last = 1 << levels, F.col("place") + F.col("copies") - 1
    start = F.greatest(F.col("place"), F.col("block") * slots)
    end = F.least(last, F.col("block") * slots + (slots - 1))
    cells = nodes.withColumn("block", F.explode(F.sequence(
        F.shiftright("place", levels), F.shiftright(last, levels)))).select(
        "grp", "block", (start - F.col("block") * slots).cast("int").alias("slot"), (end - start + 1).cast("int").alias("times"),
        "digest", "doc_id", "changed")
    return kept(in_groups(cells, ["grp", "block"], partial(_filled, levels=levels), _SLOT_SCHEMA, size=slots), "slots")


def tree(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """The rounds of slot arrays, leaves first; in the last, every group has one array, whose root is its own."""
    rounds = [_slot_arrays(nodes, levels)]
    while rounds[-1].agg(F.max("block")).first()[0]:
        rounds.append(_slot_arrays(rounds[-1].select(
            "grp", F.col("block").alias("place"), F.lit(1).cast("long").alias("copies"), F.col("root").alias("digest"),
            F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("changed")), levels))
    return rounds


def _siblings(levels: list[list[bytes]], slot: int) -> tuple[str, bytes]:
    """For each level upwards the side of the other node (``-``: none), and these nodes."""
    steps, others = [], []
    for level in levels[:-1]:
        other = slot ^ 1
        if other >= len(level):
            steps.append("-")
        else:
            steps.append("L" if slot & 1 else "R")
            others.append(level[other])
        slot >>= 1
    return "".join(steps), b"".join(others)


def fold(leaf: bytes, steps: str, siblings: bytes) -> bytes:
    """The root that a leaf and its siblings give."""
    at = 0
    for step in steps:
        if step == "-":
            leaf = _h(leaf)
            continue
        other, at = siblings[at:at + 64], at + 64
        leaf = _h(other, leaf) if step == "L" else _h(leaf, other)
    return leaf


def _arrays(batches, height: int):
    for batch in batches:
        for row in batch.to_pylist():
            yield row, _levels(_hexes(row["digests"]), row["block"], height)


def _paths_below(batches, height: int):
    for row, levels in _arrays(batches, height):
        out = []
        for slot in range(row["n"]):
            steps, others = _siblings(levels, slot)
            out.append((row["grp"], (row["block"] << height) + slot, steps + row["steps"], others + row["siblings"], row["subroot"],
                        row["top"]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PATH_ARROW)], schema=_PATH_ARROW)


def _proofs(batches, height: int):
    for row, levels in _arrays(batches, height):
        ids = np.frombuffer(row["ids"], "<i8").tolist()
        for slot in np.frombuffer(row["no_id"], "<i2").tolist():
            ids[slot] = None
        changed = dict(zip(np.frombuffer(row["changed_at"], "<i2").tolist(), _hexes(row["changed"])))
        out = []
        for slot, leaf in enumerate(levels[0]):
            steps, others = _siblings(levels, slot)
            steps, others = steps + row["steps"], others + row["siblings"]
            folded = fold(changed.get(slot, leaf), steps, others).decode()
            out.append((ids[slot], leaf.decode(), row["subroot"], row["top"], _h(others).decode(), folded, folded == row["top"]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PROOF_ARROW)], schema=_PROOF_ARROW)


def _down(rounds: list[DataFrame], paths: DataFrame, run, schema: str, height: int) -> DataFrame:
    """Hands paths of the last round's arrays down to the first round's slots."""
    for level in range(len(rounds) - 1, -1, -1):
        joined = rounds[level].drop("root").join(paths.withColumnRenamed("root", "top"), ["grp", "block"])
        paths = in_arrow(joined, partial(run if level == 0 else _paths_below, height=height),
                         schema if level == 0 else _PATH_SCHEMA)
        if level:
            paths = kept(paths, "paths")
    return paths


def ordered_places(frame: DataFrame, column: str) -> DataFrame:
    """``column`` of distinct, non-null values with ``place``, its rank: sorted by ranges, numbered range by range."""
    spread = kept(frame.select(column).repartitionByRange(column).sortWithinPartitions(column)
                  .withColumn("_range", F.spark_partition_id().cast("long")), "ranges")
    sizes = running_before(spread.groupBy("_range").agg(F.count("*").alias("_n")), [], "_range", "_n", "_earlier", levels=())
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(column)).cast("long") - 1
    return spread.withColumn("_in", inside).join(sizes, "_range").select(column, (F.col("_earlier") + F.col("_in")).alias("place"))


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """Leaf, subroot of its language, root, and the checked inclusion proof of every row.

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: ``proof_sha256`` hashes the siblings
    from leaf to root, ``folded_root`` is what the (where ``tampered`` holds, changed) leaf and these siblings give.
    Leaves of a language ascend by ``doc_id``, null ids first; rows of one id ascend by leaf; equal rows are leaves of their
    own. Null values hash as ``-``, an empty text as ``0:``; a null language is the first one. A long text is hashed whole. An empty
    table gives an empty result.
    """
    rows = kept(leaves(docs, tampered), "leaves")
    placed = coordinates(rows).withColumnRenamed("leaf", "digest")
    rounds = tree(placed, levels)
    subroots = rounds[-1].select("grp", "root")
    numbered = kept(ordered_places(subroots, "grp"), "groups")
    upper = tree(subroots.join(numbered, "grp").select(
        F.lit("").alias("grp"), "place", F.lit(1).cast("long").alias("copies"), F.col("root").alias("digest"),
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("changed")), levels)
    top = upper[-1].select("grp", "block", F.lit("").alias("steps"), F.lit(b"").alias("siblings"), F.lit("").alias("subroot"),
                           F.lower(F.hex("root")).alias("root"))
    by_place = kept(_down(upper, top, _paths_below, _PATH_SCHEMA, levels), "paths")
    of_group = (by_place.select(F.col("block").alias("place"), "steps", "siblings", F.col("root").alias("top"))
                .join(numbered, "place").join(subroots, "grp")
                .select("grp", F.lit(0).cast("long").alias("block"), "steps", "siblings",
                        F.lower(F.hex("root")).alias("subroot"), F.col("top").alias("root")))
    return _down(rounds, of_group, _proofs, _PROOF_SCHEMA, levels)
