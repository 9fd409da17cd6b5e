"""The positional index against a scan of all windows."""

import hashlib
import re

from conftest import SMALL
from fixtures import ODD, documents, widened
from hypothesis import given, settings, strategies as st

from rosterloom.llm import decontamination as dc
from rosterloom.llm.common import table
from rosterloom.llm.queries import op10_decontamination

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def own_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = own_words(text)
        if w and item is not None:
            for k in range(max(1, len(w) - size + 1)):
                windows.setdefault(tuple(w[k:k + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for key, text in docs:
        w, hit, found = own_words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k:k + n]))):
                    found |= own
                    hit.update(range(k, k + n))
        out.append((key, len(w), len(hit), ",".join(sorted(found))))
    return sorted(out, key=str)


def found(frame):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["items"])) for r in frame.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SMALL, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    expected = [(k, n, h, len(i.split(",")) if i else 0, hashlib.sha256(i.encode()).hexdigest(), h > 0) for k, n, h, i in brute(docs, items)]
    got = [tuple(r)[:6] for r in op10_decontamination(spark, SMALL).collect()]
    assert sorted(got) == sorted(expected)
    assert any(r[5] for r in got)


ITEMS = [(1, "Alpha beta gamma"), (10, "alpha, BETA gamma"), (2, " ".join(f"t{i}" for i in range(14))), (3, None), (None, "one"), (4, "!!"), (5, "one")]


def test_odd_rows_and_blocks(spark):
    tokens = [f"t{i}" for i in range(14)]
    rows = [*ODD, (20, "x alpha beta gamma alpha beta gamma y"), (21, " ".join(tokens)), (22, " ".join(tokens[2:12] * 2)), (23, "gamma beta x alpha"), (24, "alpha-beta gamma" * 3)]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    frame = widened(documents(spark, rows))
    assert found(dc.contamination(frame, bench)) == brute(rows, ITEMS)
    assert found(dc.contamination(frame, bench, block_bytes=20)) == brute(rows, ITEMS)
    near = {r["doc_id"]: r["near_items"] for r in dc.contamination(frame, bench).collect()}
    assert near[23] == ["1", "10"] and near[21] == ["2"]


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.contamination(documents(spark, []), bench).collect() == []
    assert found(dc.contamination(documents(spark, [(1, "a b")]), bench)) == [(1, 2, 0, "")]


def test_clean_keeps_columns_and_other_rows(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = widened(documents(spark, [(1, "alpha beta gamma"), (2, "fine"), (2, "fine"), (None, None), (2, "has one in")]))
    out = dc.clean(docs, bench)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in out.where("doc_id IS NOT NULL").collect()) == [(2, "fine"), (2, "fine")]
    assert out.count() == 3


def test_segments_do_not_lose_or_join_matches(spark):
    docs = [(k, "alpha beta") for k in range(20)] + [(k, "gamma alpha beta gamma") for k in range(20, 40)]
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    frame = documents(spark, docs).coalesce(1)
    index = dc.build_index(frame, {"alpha", "beta", "gamma"}, segment_bytes=100)
    assert index.count() > 5
    queries = next(dc.query_blocks(bench))
    rows = dc.search(index, queries, {}).collect()
    assert sorted(int(r["doc_id"]) for r in rows if r["items"]) == list(range(20, 40))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_words(text):
    assert dc.words(text) == own_words(text)
