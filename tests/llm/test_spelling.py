"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SMALL
from fixtures import ODD, documents, widened
from hypothesis import HealthCheck, given, settings, strategies as st

from rosterloom.llm import spelling
from rosterloom.llm.common import table
from rosterloom.llm.queries import op11_spelling_variants


def brute_words(docs):
    counts = Counter()
    for key, text in docs:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def is_near(a, b):
    """Exactly one inserted, deleted or replaced letter, by the rest behind the common prefix."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1:] == b[k + 1:] or a[k + 1:] == b[k:] or a[k:] == b[k + 1:]


def brute_groups(counts, near):
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 10 * n:
            form[word] = best
    out = []
    for word, n in counts.items():
        root = word
        while root in form:
            root = form[root]
        f = form.get(word)
        out.append((word, f, root, n, len(near[word]), counts.get(f)))
    return sorted(out)


def all_near(words):
    return {w: [v for v in words if is_near(w, v)] for w in words}


def by_deletion(words):
    """The near words through shared deletions, for larger vocabularies."""
    at, whole = {}, set(words)
    for w in words:
        for k in range(len(w)):
            at.setdefault((k, w[:k] + w[k + 1:]), set()).add(w)
    near = {w: set() for w in words}
    for (_, rest), found in at.items():
        for w in found:
            near[w] |= found - {w}
            if rest in whole:
                near[w].add(rest)
                near[rest].add(w)
    return near


def got(frame):
    return sorted(map(tuple, frame.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_query_equals_brute_force(spark):
    counts = brute_words([(r["doc_id"], r["text"]) for r in table(spark, SMALL, "documents").collect()])
    assert got(op11_spelling_variants(spark, SMALL)) == brute_groups(counts, by_deletion(counts))


def test_odd_rows(spark):
    docs = [*ODD, (20, "Überfluß ÜBERFLUSS Überfluß überfluss × a×bcdefg a×bcdefg ÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷")]
    counts = brute_words(docs)
    assert counts and got(spelling.spelling_groups(widened(documents(spark, docs)))) == brute_groups(counts, all_near(counts))


def test_empty_table(spark):
    assert spelling.spelling_groups(documents(spark, [])).collect() == []


def test_one_letter_is_lost_by_the_checksum(spark):
    docs = [(k, "singular singular") for k in range(400)]
    counts = brute_words(docs)
    assert len(counts) > 3
    assert {r["word"]: r["n"] for r in spelling.words(documents(spark, docs)).collect()} == counts


@pytest.mark.parametrize("block", [7, 64, 10_000])
def test_blocks_do_not_change_the_pairs(spark, block):
    """One crowded bucket: the same first and last letters, many lanes and many blocks."""
    draw = random.Random(block)
    words = sorted({"aaaa" + "".join(draw.choice("abcé") for _ in range(draw.choice((3, 4, 5)))) for _ in range(400)})
    counts = {w: draw.choice((2, 3, 3, 40, 500)) for w in words}
    near = {r["word"]: (r["n_near"], r["best"], r["best_n"]) for r in spelling.near_words(
        spark.createDataFrame(list(counts.items()), "word string, n long"), block=block).collect()}
    wanted = {}
    for w, found in all_near(words).items():
        if found:
            best = min(found, key=lambda v: (-counts[v], v))
            wanted[w] = (len(found), best, counts[best])
    assert near == wanted


def test_long_words(spark):
    base = "".join(random.Random(3).choices("abcdefgh", k=5000))
    words = [base, base + "x", base[:2500] + base[2501:], "q" + base[1:], base[:4999] + "z", base[::-1]]
    near = {r["word"]: r["n_near"] for r in spelling.near_words(
        spark.createDataFrame([(w, 2) for w in words], "word string, n long")).collect()}
    assert near == {w: len(v) for w, v in all_near(words).items() if v}


def test_chains_end_at_the_root(spark):
    forms = [(f"w{k}", f"w{k + 1}") for k in range(18)] + [("other", "w5")]
    found = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert found == {w: "w18" for w, _ in forms}


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text("abà", min_size=7, max_size=10), min_size=2, max_size=60))
def test_recurrence_by_side(words):
    """Both ends together give each pair once, here straight from the lanes of one call."""
    import numpy as np
    out = []
    for m in range(7, 11):
        for end in (0, 1):
            head, tail = -(-m // 2), m // 2
            key = (lambda w: w[-tail:]) if end else (lambda w: w[:head])
            found = sorted((w for w in words if len(w) in (m, m + 1)), key=lambda w: (key(w), w))
            if not found:
                continue
            keys = sorted({key(w) for w in found})
            group = np.array([keys.index(key(w)) for w in found])
            every = np.ones(len(found), bool)
            row, near = spelling._pairs(found, group, every, every, m, end)
            out += [(found[a], found[b]) for a, b in zip(row, near)]
    assert sorted(out) == sorted((w, v) for w, found in all_near(words).items() for v in found)
