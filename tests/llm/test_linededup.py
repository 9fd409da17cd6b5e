"""Patience alignment on its own, and deletions against a brute-force version."""

import random
import re

from conftest import SMALL
from fixtures import ODD, documents, widened
from hypothesis import given, settings, strategies as st

from rosterloom.llm import linededup
from rosterloom.llm.common import table
from rosterloom.llm.queries import op4_line_dedup

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(rows, min_words=linededup.MIN_WORDS):
    """Text by (id, text): every document against the earlier holders of its rare lines, and
    the earliest holder of each common one."""
    nodes = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    lines = {n: [(i, x, len(WORD.findall(x))) for i, x in enumerate(y for y in n[2].split("\n") if WORD.search(y))] for n in nodes}
    holders, times = {}, {}
    copies = {n: sum((r[0] is None, r[0] or 0, r[1] or "") == n for r in rows) for n in nodes}
    for n in nodes:
        for _, x, _ in lines[n]:
            times[x] = times.get(x, 0) + copies[n]
            if n not in holders.setdefault(x, []):
                holders[x].append(n)
    out = {}
    for n in nodes:
        shared, gone = {}, set()
        for _, x, w in lines[n]:
            found = holders[x] if times[x] <= linededup.RARE else holders[x][:1]
            for m in found:
                if m < n:
                    shared[m] = shared.get(m, 0) + w * copies[n]
        for owner, words in shared.items():
            if words < min_words:
                continue
            ids = {}
            seq = lambda m: [{"i": i, "h": ids.setdefault(x, len(ids)), "w": w} for i, x, w in lines[m]]
            gone.update(linededup.common_blocks(seq(owner), seq(n), min_words))
        k, left = -1, []
        for x in n[2].split("\n"):
            if WORD.search(x):
                k += 1
                if k in gone:
                    continue
            left.append(x)
        out[n] = "\n".join(left)
    return out


def check(rows, got, min_words=linededup.MIN_WORDS):
    of = brute(rows, min_words)
    expected = [(r[0], r[1] if of[r[0] is None, r[0] or 0, r[1] or ""] == (r[1] or "") else of[r[0] is None, r[0] or 0, r[1] or ""]) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SMALL, "documents").collect()]
    result = op4_line_dedup(spark, SMALL).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in result])
    assert any(r["n_gone"] for r in result)
    assert all(s < r["doc_id"] for r in result for s in r["sources"])


def passage(k, n=3, words=20):
    return "\n".join(" ".join(f"p{k}l{j}w{i}" for i in range(words)) for j in range(n))


def test_passages_go_from_later_documents(spark):
    own = lambda k: passage(f"own{k}", 2)
    rows = [(1, own(1) + "\n" + passage("a")), (2, passage("a") + "\n" + own(2)), (3, own(3) + "\n\n" + passage("a") + "\nshort line\n" + own("3b")),
            (4, "short line\n" + own(4)), (5, own(1) + "\n" + passage("a")), *((k and k + 50, t) for k, t in ODD), (6, passage("b")), (6, passage("b")), (7, passage("b", 2))]
    frame = linededup.dedup_lines(widened(documents(spark, rows)))
    result = frame.collect()
    check(rows, [(r["doc_id"], r["text"]) for r in result])
    text = {r["doc_id"]: r["text"] for r in result if r["doc_id"]}
    assert text[1] == rows[0][1] and text[2] == own(2) and "short line" in text[3] and text[4] == rows[3][1]
    assert text[5] == ""
    state = {r["doc_id"]: r[frame.columns[-1]] for r in result}
    assert state[3]["sources"] == [1, 2] and state[3]["words_gone"] == 60 and state[3]["n_gone"] == 3


def test_columns_and_emptied_documents(spark):
    rows = [(1, passage("x")), (2, passage("x")), (3, passage("x") + "\nmore"), (4, ""), (5, None)]
    docs = widened(documents(spark, rows))
    out = linededup.cleaned(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert got == {1: (passage("x"), len(passage("x"))), 3: ("more", 4), 4: ("", 0), 5: (None, None)}


def test_a_passage_whose_lines_began_elsewhere(spark):
    """No earliest holder shares enough with the last document; the second one does, through rare lines."""
    pieces = [" ".join(f"q{j}w{i}" for i in range(8)) for j in range(5)]
    rows = [*((k, pieces[k]) for k in range(5)), (10, "\n".join(pieces)), (11, "\n".join(pieces))]
    frame = linededup.dedup_lines(documents(spark, rows))
    state = {r["doc_id"]: r[frame.columns[-1]] for r in frame.collect()}
    assert state[11]["n_gone"] == 5 and state[11]["sources"] == [10] and state[10]["n_gone"] == 0


def test_empty_table(spark):
    assert linededup.dedup_lines(documents(spark, [])).collect() == []


def test_hot_passage_makes_one_pair_per_document(spark):
    rows = [(k, passage("hot") + "\n" + passage(f"u{k}", 1)) for k in range(400)]
    gone = linededup.deletions(documents(spark, rows)).collect()
    assert len(gone) == 399 and all(len(g["gone"]) == 3 and g["sources"] == [0] for g in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_alignment_is_valid(a, b):
    pairs = linededup.patience(a, b)
    assert all(a[x] == b[y] for x, y in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    if a == b:
        assert len(pairs) == len(a)


def test_unique_lines_are_fully_aligned():
    draw = random.Random(3)
    a = draw.sample(range(1000), 200)
    b = sorted(draw.sample(range(200), 120))
    assert linededup.patience(a, [a[k] for k in b]) == [(k, j) for j, k in enumerate(b)]


def all_pairs(rows, min_words=linededup.MIN_WORDS):
    """Numbers of the lines, by id, that lie in a run of ``min_words`` shared with any earlier document: no line is rare or common."""
    lines = {k: [(x, len(WORD.findall(x))) for x in (t or "").split("\n") if WORD.search(x)] for k, t in rows}
    places, out = {}, {}
    for k in sorted(lines):
        own, gone = lines[k], set()
        meets = {(m, j - i) for i, (x, _) in enumerate(own) for m, j in places.get(x, ())}
        for m, shift in meets:
            run, words = [], 0
            for i in range(len(own) + 1):
                if i < len(own) and 0 <= i + shift < len(lines[m]) and lines[m][i + shift][0] == own[i][0]:
                    run, words = [*run, i], words + own[i][1]
                    continue
                gone.update(run if words >= min_words else [])
                run, words = [], 0
        for j, (x, _) in enumerate(own):
            places.setdefault(x, []).append((k, j))
        out[k] = gone
    return out


def test_a_passage_of_common_lines_that_began_elsewhere(spark):
    pieces = [" ".join(f"q{j}w{i}" for i in range(8)) for j in range(5)]
    rows = [*((k, pieces[k]) for k in range(5)), *((k, f"own {k}\n" + "\n".join(pieces)) for k in range(10, 17))]
    frame = linededup.dedup_lines(documents(spark, rows))
    state = {r["doc_id"]: r[frame.columns[-1]] for r in frame.collect()}
    assert all(state[k]["n_gone"] == 5 and state[k]["sources"] == [10] for k in range(11, 17))
    assert all(state[k]["n_gone"] == 0 for k in (0, 1, 2, 3, 4, 10))


def test_common_and_rare_lines_against_all_pairs(spark):
    draw = random.Random(8)
    line = lambda: " ".join(f"z{draw.randrange(3)}" if k == 0 else f"y{k}" for k in range(draw.choice((3, 7, 12))))
    rows = [(k, "\n".join(line() for _ in range(draw.randrange(14)))) for k in range(60)]
    gone = {int(r["node"].split(":")[0]): set(r["gone"]) for r in linededup.deletions(documents(spark, rows)).collect()}
    expected = {k: v for k, v in all_pairs(rows).items() if v}
    assert len(expected) > 20 and gone == expected


def test_query_equals_all_pairs(spark):
    larger = SMALL.replace("0.001", "0.01")
    docs = table(spark, larger, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert len({k for k, _ in rows}) == len(rows)
    gone = {int(r["node"].split(":")[0]): set(r["gone"]) for r in linededup.deletions(docs).collect()}
    assert gone == {k: v for k, v in all_pairs(rows).items() if v}


def test_alignment_decides(spark, monkeypatch):
    rows = [(1, passage("a") + "\n" + passage("b")), (2, "own\n" + passage("b") + "\nbetween\n" + passage("a"))]
    gone = linededup.deletions(documents(spark, rows)).collect()
    assert [sorted(g["gone"]) for g in gone] == [[1, 2, 3, 5, 6, 7]]  # blocks in changed order go as well
    monkeypatch.setattr(linededup, "common_blocks", lambda *_: [])
    assert linededup.deletions(documents(spark, rows)).collect() == []


def test_lines_that_agree_in_one_hash_only_stay():
    line = lambda i, g: {"i": i, "h": i, "w": 12, "g": g}
    earlier = [line(k, 0) for k in range(4)]
    assert linededup.common_blocks(earlier, [line(0, 0), line(1, 0), line(2, 9), line(3, 0)], 20) == [0, 1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14))
def test_blocks_are_all_common_runs(a, b):
    seq = lambda x: [{"i": k, "h": h, "w": 8} for k, h in enumerate(x)]
    expected = {j + k for j in range(len(b) - 2) for i in range(len(a) - 2) if a[i:i + 3] == b[j:j + 3] for k in range(3)}
    assert set(linededup.common_blocks(seq(a), seq(b), 20)) == expected


def test_a_very_long_text(spark):
    lines = [f"a{k} b{k} c{k} d{k} e{k}" for k in range(100_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines[50_000:]) + "\n\nown words\n" + "\n".join(lines[:50_000]))]
    frame = linededup.dedup_lines(documents(spark, rows))
    got = {r["doc_id"]: r for r in frame.collect()}
    assert got[1]["text"] == rows[0][1] and got[2]["text"] == "\nown words"
    assert got[2][frame.columns[-1]]["n_gone"] == 100_000 and got[2][frame.columns[-1]]["words_gone"] == 500_000
