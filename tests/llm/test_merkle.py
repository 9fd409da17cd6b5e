"""The manifest against a tree built in plain Python."""

import zlib
from hashlib import sha256

import pytest
from conftest import SMALL
from fixtures import ODD, SCHEMA, documents, widened
from pyspark.sql import functions as F

from rosterloom.llm import merkle
from rosterloom.llm.common import table
from rosterloom.llm.grouped import running_before
from rosterloom.llm.queries import op12_merkle_manifest


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*(field(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))


def climb(nodes):
    """Siblings of every node upwards, by level, and the last node."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            first = i - i % 2
            run = nodes[first:first + 2]
            paths[k].append((run[:i - first], run[i - first + 1:]))
            at[k] = i // 2
        nodes = [h(*nodes[k:k + 2]) for k in range(0, len(nodes), 2)]
    return paths, nodes[0]


def brute_manifest(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {x: sorted((r for r in rows if r["lang"] == x), key=lambda r: (
        r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r))) for x in langs}
    inner = {x: climb([leaf_of(r) for r in group]) for x, group in groups.items()}
    upper, root = climb([inner[x][1] for x in langs]) if rows else ([], None)
    out = []
    for x, above in zip(langs, upper):
        for r, path in zip(groups[x], inner[x][0]):
            cut = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None
            node = leaf_of(dict(r, n_chars=r["n_chars"] + 1) if cut else r)
            for left, right in path + above:
                node = h(*left, node, *right)
            out.append((r["doc_id"], leaf_of(r), inner[x][1], root, h(*(s for a, b in path + above for s in a + b)), node, node == root))
    return sorted(out, key=str)


def of(docs, levels=merkle.LEVELS):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return sorted(map(tuple, merkle.manifest(docs, tampered, levels).collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [r.asDict() for r in table(spark, SMALL, "documents").collect()]
    found = sorted(map(tuple, op12_merkle_manifest(spark, SMALL).collect()), key=str)
    assert found == brute_manifest(rows)
    assert {f[6] for f in found} == {True, False}


def test_odd_rows(spark):
    docs = documents(spark, [(*r, x) for r, x in zip(ODD, [None, "de", "", "en", "é", "en", "en", None, None, "de", "de", "\U0001F600"])])
    assert of(widened(docs)) == brute_manifest([r.asDict() for r in docs.collect()])


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5])
def test_small_trees(spark, n):
    rows = [(-k * 70_000, f"t{k}", "en", None, k) for k in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert of(docs) == brute_manifest([r.asDict() for r in docs.collect()])


def test_many_arrays_repeated_ids_and_far_ids(spark):
    """Small slot arrays: several rounds in both trees; ids of one container, far apart, negative and repeated."""
    rows = [(k * k * (1 if k % 3 else -1_000_003), f"t{k}", f"l{k % 23:02d}", "s", k) for k in range(300)]
    rows += [(50, f"same id {k}", "l05", None, 1) for k in range(40)] + [(50, "same row", "l05", "s", 2)] * 37
    rows += [(2**63 - 1, "last", "l05", "s", 2**63 - 1), (-2**63, "first", "l05", "s", None), (None, "none", "l05", "s", 3), (None, "none", "l05", "s", 3)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert of(docs, 2) == brute_manifest([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows])


def test_places_are_ranks(spark):
    import random
    draw = random.Random(5)
    ids = [draw.randrange(-200_000, 200_000) for _ in range(5000)] + [7] * 300
    rows = spark.createDataFrame([("=x", k, bytes([n % 256, n // 256]), None, 1) for n, k in enumerate(ids)],
                                 "grp string, doc_id long, leaf binary, changed binary, copies long").repartition(5)
    got = {r["leaf"]: r["place"] for r in merkle.coordinates(rows).collect()}
    want = sorted((k, bytes([n % 256, n // 256])) for n, k in enumerate(ids))
    assert got == {leaf: place for place, (_, leaf) in enumerate(want)}


def test_running_sums_over_levels(spark):
    data = [("a", (k * 7919) % 1000 - 500, k) for k in range(1000)] + [("b", 5, 3)]
    frame = running_before(spark.createDataFrame(data, "g string, o long, v long"), ["g"], "o", "v", "before", levels=(8, 4))
    assert {(r["g"], r["o"]): r["before"] for r in frame.collect()} == {
        (g, o): sum(v for x, p, v in data if x == g and p < o) for g, o, _ in data}
