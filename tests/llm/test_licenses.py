"""Planted licenses, exact and altered, and alignment against a full table."""

import random

import numpy as np
from conftest import SMALL
from fixtures import ODD, documents, widened
from hypothesis import given, settings, strategies as st

from rosterloom.llm import licenses
from rosterloom.llm.common import table
from rosterloom.llm.queries import op6_license_scan


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=12), st.lists(st.integers(0, 5), max_size=12))
def test_wide_band_is_a_longest_common_subsequence(a, b):
    n, first, last = licenses.align(np.array(a), np.array(b), 0, 30)
    assert n == lcs(a, b)
    assert lcs(a, b[first:last]) == n


def test_all_templates_are_found_where_they_lie(spark):
    rows, expected = [], {}
    for k, (name, text) in enumerate(licenses.TEMPLATES.items()):
        rows.append((k, f"# lead é words\n{text.upper()} trailing words here"))
        expected[k] = name
    rows.append((100, "nothing of the kind, all rights are reserved elsewhere"))
    result = {r["doc_id"]: r["licenses"] for r in licenses.scan(documents(spark, rows)).collect()}
    for k, name in expected.items():
        assert [x["license"] for x in result[k]] == [name]
        assert result[k][0]["coverage"] == 1.0 and result[k][0]["first"] == rows[k][1].index("\n") + 1
    assert result[100] == []


def test_altered_template_is_found_with_its_coverage(spark):
    words = licenses.TEMPLATES["MIT"].split()
    draw = random.Random(2)
    lost = set(draw.sample(range(len(words)), len(words) // 10))
    text = "before " * 50 + " ".join(("new" if k % 2 else "") if k in lost else w for k, w in enumerate(words)) + " after" * 50
    row = licenses.scan(documents(spark, [(1, text)])).first()
    assert [x["license"] for x in row["licenses"]] == ["MIT"]
    assert 0.85 <= row["licenses"][0]["coverage"] < 1


def test_query_finds_what_a_plain_search_finds(spark):
    larger = SMALL.replace("0.001", "0.01")
    docs = {r["doc_id"]: r["text"] for r in table(spark, larger, "documents").collect()}
    rows = op6_license_scan(spark, larger).collect()
    assert len(rows) == len(docs)
    short = {n: t for n, t in licenses.TEMPLATES.items() if len(t) < 100}
    plain = {(k, n) for k, text in docs.items() for n, t in short.items() if t in text}
    found = {(r["doc_id"], x["license"]) for r in rows for x in r["licenses"]}
    assert plain and plain <= found
    for r in rows:
        for x in r["licenses"]:
            if x["coverage"] == 1.0 and x["license"] in short:
                assert docs[r["doc_id"]][x["first"]:x["last"]].lower().rstrip(".") == short[x["license"]].lower().rstrip(".")


def test_odd_rows(spark):
    rows = [*ODD, (20, "All rights reserved. " * 300), (21, "İ All rights reserved.")]
    result = licenses.scan(widened(documents(spark, rows))).collect()
    assert len(result) == len(rows)
    by = {r["doc_id"]: r for r in result}
    assert len(by[20]["licenses"]) == 300 and [x["license"] for x in by[21]["licenses"]] == ["all-rights-reserved"]
    assert by[1]["licenses"] == [] and by[1]["n_words"] == 0
    assert licenses.scan(documents(spark, [])).collect() == []


def test_every_license_line_of_the_documents_is_found(spark):
    """Lines are searched by their wording, not by the templates."""
    import re
    larger = SMALL.replace("0.001", "0.01")
    wording = re.compile(r"(?:licensed|released|distributed|dedicated)[^\n]{0,40} under [^\n]*?(?:\.(?=\s|$)|$)|all rights reserved", re.I | re.M)
    rows = {r["doc_id"]: r["licenses"] for r in op6_license_scan(spark, larger).collect()}
    seen = set()
    for r in table(spark, larger, "documents").collect():
        for m in wording.finditer(r["text"] or ""):
            seen.add(m.group().lower())
            assert any(x["first"] < m.end() and m.start() < x["last"] for x in rows[r["doc_id"]]), m.group()
    assert len(seen) >= 5


def test_close_licenses_are_told_apart(spark):
    lines = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0-short-notice", "Licensed under CC BY 4.0.": "CC-BY-4.0-short-notice",
        "licensed under CC BY-NC-SA 3.0": "CC-BY-NC-SA-3.0-short-notice", "Licensed under CC0 1.0.": "CC0-1.0-short-notice",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0-notice",
        "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0-notice",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0-notice",
        licenses.TEMPLATES["BSD-2-Clause-text"]: "BSD-2-Clause-text", licenses.TEMPLATES["MIT-text"]: "MIT-text"}
    result = {r["doc_id"]: r["licenses"] for r in licenses.scan(documents(
        spark, [(k, f"some words\n{x}\nand more") for k, x in enumerate(lines)])).collect()}
    assert [[x["license"] for x in result[k]] for k in range(len(lines))] == [[n] for n in lines.values()]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=12), st.lists(st.integers(0, 5), max_size=12), st.integers(-6, 12), st.integers(0, 5))
def test_bound_is_never_below_the_alignment(a, b, start, band):
    a, b = np.array(a, np.uint64), np.array(b, np.uint64)
    assert licenses.most_aligned(a, b, start, band) >= licenses.align(a, b, start, band)[0]
