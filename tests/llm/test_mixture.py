"""Mixture packing: the tokenizers file's ids, rules of a packing, and proportions of its windows."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL
from fixtures import ODD, SCHEMA, documents, widened
from hypothesis import given, settings, strategies as st

from rosterloom.llm import mixture
from rosterloom.llm.common import table
from rosterloom.llm.queries import op13_mixture_packing


@pytest.fixture(scope="module")
def ids_of():
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(mixture.tokenizer_file())
    return lambda text: full.encode(text or "", add_special_tokens=False).ids + [1]


def check_packing(rows, docs, ids_of, capacity=2048):
    """Every id in one piece, sequences without gaps, and full but for powers of two."""
    wanted = Counter()
    for key, text in docs:
        wanted[key, tuple(ids_of(text))] += 1
    lengths = {key: sorted(len(ids) for (k, ids), n in wanted.items() if k == key for _ in range(n)) for key, _ in docs}
    got = defaultdict(int)
    for r in rows:
        got[r["doc_id"]] += r["length"]
        assert any(
            zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"] and len(ids) == r["doc_tokens"]
            for (k, ids) in wanted if k == r["doc_id"])
    assert got == {k: sum(v) for k, v in lengths.items()}
    for key, sizes in lengths.items():  # starts and lengths of one id tile its documents
        if len(sizes) == 1:
            at = 0
            for r in sorted((r for r in rows if r["doc_id"] == key), key=lambda r: r["start"]):
                assert r["start"] == at and r["length"] > 0
                at += r["length"]
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)


def test_query_packs_everything(spark, ids_of):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SMALL, "documents").collect()]
    check_packing(op13_mixture_packing(spark, SMALL).collect(), docs, ids_of)


def test_odd_rows(spark, ids_of):
    docs = [*ODD, (30, "X<|ENDOFTEXT|>y <|startoftext|><|endoftext|>z. it's O'Neil's,\x1c\x85 tab\tand\x0bmore i̇ é ́x ΑΣ Σ"),
            (31, "a" * 5000), (32, "...!?;: don't, rock'n'roll. 12,345.67 ２３"), (33, "e\ń e ́")]
    frame = widened(documents(spark, docs)).drop("ids")
    check_packing(mixture.pack(frame).collect(), docs, ids_of)


def test_empty_table(spark):
    assert mixture.pack(documents(spark, [])).collect() == []


def _sources(spark, sizes, seed=1):
    """Documents of given token numbers by source: words of one token each."""
    rows = [(k, " ".join(["the"] * (n - 1)), "en", source, None) for k, (source, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, SCHEMA)


def _mix(rows, capacity):
    by = defaultdict(Counter)
    for r in rows:
        by[r["sequence_id"]][r["source"]] += r["length"]
    return {k: v for k, v in by.items() if sum(v.values()) == capacity}


def test_windows_mix_sources_and_deficits_cross_partitions(spark):
    sizes = [("a", 700)] * 300 + [("b", 90)] * 800 + [(None, 37)] * 300 + [("big", 60_000)] + [("tiny", 5)]
    docs = _sources(spark, sizes)
    found = mixture.kept(mixture.tokens(docs, mixture.tokenizer_file()), "t")
    queued = mixture.kept(mixture.queues(found.drop("ids", "doc_id")), "q")
    names = {r["row"]: r["source"] for r in found.select("row", "source").collect()}
    total = sum(n for _, n in sizes)
    parts = mixture.schedule(queued, span=20_000).collect()
    assert sum(r["length"] for r in parts) == total
    served, windows = Counter(), defaultdict(Counter)
    for r in parts:
        windows[r["sequence_id"]][names[r["row"]]] += r["length"]
    share = {s: sum(n for x, n in sizes if ("" if x is None else f"={x}") == s) / total for s in set(names.values())}
    full = [k for k, v in windows.items() if sum(v.values()) == 2048]
    assert len(full) == total // 2048
    for done, k in enumerate(sorted(full), 1):
        served.update(windows[k])
        for s, part in share.items():
            # Each window is near the mixture, and what it lacks is carried, across partitions too.
            assert abs(windows[k][s] - 2048 * part) <= 4 * mixture.TURN
            assert abs(served[s] - 2048 * done * part) <= 4 * mixture.TURN + 2048 * part * 0.25


def test_targets_hold_until_a_queue_runs_out(spark):
    docs = _sources(spark, [("a", 100)] * 300 + [("b", 100)] * 300)
    mix = _mix(mixture.pack(docs, capacity=512, targets={"a": 3.0, "b": 1.0}).collect(), 512)
    first = [mix[k] for k in sorted(mix)][:60]
    assert all(abs(v["a"] - 384) <= 2 * mixture.TURN for v in first)
    assert sum(v["a"] for v in first) == pytest.approx(60 * 384, rel=0.02)
    with pytest.raises(ValueError):
        mixture.pack(docs, targets={"a": 0.0})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(1, 900)), min_size=1, max_size=40), st.integers(0, 5000))
def test_one_partition_serves_all_in_order(pieces, before):
    """Whatever the pieces: all tokens once, in the queue's order, places without gaps."""
    sizes = Counter()
    for s, n in pieces:
        sizes[s] += n
    total = sum(sizes.values())
    places = mixture._Places(before + total, 512)
    given_pieces = [(s, row, 0, n) for row, (s, n) in enumerate(pieces)]
    out = list(mixture.serve(given_pieces, {s: n / total for s, n in sizes.items()}, dict.fromkeys(sizes, 0.0), before, places))
    at = before
    for row, start, length, sequence, offset in out:
        assert places.at(at)[:2] == (sequence, offset)
        at += length
    assert at == before + total
    for s in sizes:
        rows = [(r, a, n) for r, a, n, _, _ in out if pieces[r][0] == s]
        assert rows == sorted(rows) and sum(n for _, _, n in rows) == sizes[s]


def test_word_cache_keeps_its_bound_within_one_text():
    words = mixture._Words(mixture.tokenizer_file(), "<u2")
    words.LIMIT = 100_000
    words.text(" ".join(f"w{k}x" for k in range(20_000)))
    assert words._bytes <= 100_000 and len(words) < 1000


def test_fast_ids_equal_the_tokenizers_file():
    import random
    words, draw = mixture._Words(mixture.tokenizer_file(), "<u2"), random.Random(9)
    letters = "etaoinshrdlu" * 3 + "bcfgjkmpqvwxyz" + "ABCDEFGH'" + "éüßÀÖøÿ×÷" + "0123456789.,;:!?#$%&*()[]{}<>|_-+=/\\\"'~^`@"
    parts = {"".join(draw.choices(letters[:n], k=draw.randint(1, 14))) for n in (36, 50, 59, 68, len(letters)) for _ in range(15_000)}
    parts |= {w for w in "don't IT'S we'll I'd''s 'Sx 's's a'b'rex 12ab34 x<|y ÀÉ'RE".split()} | set(words._full.get_vocab())
    for part in parts:
        if not any(c.isspace() for c in part):
            wanted = words._full.encode(part, add_special_tokens=False).ids
            assert words.encode(part) == wanted, part
            assert np.frombuffer(words[part], "<u2").tolist() == wanted, part


def test_unseen_words_are_encoded_together(monkeypatch):
    words = mixture._Words(mixture.tokenizer_file(), "<u2")
    fast, calls = words._fast, []

    class Counted:
        def encode_ordinary(self, text):
            calls.append(text)
            return fast.encode_ordinary(text)

    monkeypatch.setattr(words, "_fast", Counted())
    words.text(" ".join(f"word{k}" for k in range(5000)))
    assert len(calls) == 1
    words.text(" ".join(f"word{k}" for k in range(5000)))
    assert len(calls) == 1


def test_ids_of_texts_equal_the_tokenizers_file(monkeypatch):
    import pyarrow as pa
    words = mixture._Words(mixture.tokenizer_file(), "<u2")
    monkeypatch.setattr(words, "SLICE", 7)  # texts over several slices, slices over several texts
    monkeypatch.setattr(words, "CALL", 3)
    monkeypatch.setattr(words, "LIMIT", 3000)
    texts = ["", " ", "\n", "a  b\n\nc ", "it's “quoted” — 12,5 <|endoftext|> <|startoftext|>x a<| |b", "日本語 é ÀÉ'RE ΑΣ tab\tand\x00zero",
             "x" * 300, *(" ".join(f"w{j * k % 97} Don't," for j in range(40)) for k in range(20)), ""]
    wanted = [words._full.encode(x, add_special_tokens=False).ids for x in texts]
    for _ in range(2):
        found = words.texts(pa.array(texts), b"\1\0").to_pylist()
        assert [np.frombuffer(x, "<u2").tolist() for x in found] == [[*ids, 1] for ids in wanted]
        assert words._bytes <= 3000
    assert words.texts(pa.array([], pa.string()), b"\1\0").to_pylist() == []
