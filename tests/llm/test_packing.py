"""Tokens against the tokenizers file, places against the rules of a packing."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from fixtures import ODD, documents, widened
from hypothesis import given, settings, strategies as st

from rosterloom.llm import packing
from rosterloom.llm.common import table


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.tokenizer_files()[0])


def expected_pieces(tokenizer, rows, capacity=packing.CAPACITY):
    out = []
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for piece, start in enumerate(starts):
            own = ids[start:first if piece == 0 else start + capacity]
            out.append((key, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return Counter(out)


def check_places(rows, capacity=packing.CAPACITY):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_whole_table(spark, tokenizer):
    docs = table(spark, SMALL, "documents")
    rows = packing.pack(docs).collect()
    expected = expected_pieces(tokenizer, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    used, least = check_places(rows), -(-sum(r["length"] for r in rows) // packing.CAPACITY)
    assert used <= 1.02 * least + 1


def test_odd_rows(spark, tokenizer):
    rows = packing.pack(widened(documents(spark, ODD))).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected_pieces(tokenizer, ODD)
    check_places(rows)


def test_empty_table(spark):
    assert packing.pack(documents(spark, [])).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB é漢1,.'\"\n\t - <|>", max_size=40))
def test_word_cache_equals_tokenizer(text):
    encoder = packing._encoder(*packing.tokenizer_files())
    assert encoder.text(text) == np.array(encoder._full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece(seed):
    draw = random.Random(seed)
    counts = {n: draw.randrange(1, 3000) for n in draw.sample(range(1, 1025), draw.choice([1, 5, 60, 300]))}
    bins = packing.plan(counts)
    packed = Counter()
    for pattern, times in bins:
        assert times > 0 and sum(n * a for n, a in pattern) <= 1024
        for n, a in pattern:
            packed[n] += a * times
    assert packed == counts
    used, alone = sum(t for _, t in bins), sum(t for _, t in packing._best_fit(counts, 1024))
    assert used <= alone * 1.001 + 1


def test_plan_finds_what_best_fit_misses():
    # Thirds and sixths whose best-fit packing wastes room: 500 pairs with 262 + 262, and so on.
    counts = {500: 600, 262: 1200}
    assert sum(t for _, t in packing.plan(counts)) == 600


def test_hot_length_is_spread_over_buckets(spark):
    parts = spark.range(5000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "CAST(IF(id % 3 = 0, 1024, 300) AS LONG) AS length")
    rows = packing.place(parts).collect()
    assert len(rows) == 5000
    check_places(rows)


def test_word_cache_keeps_its_bound_within_one_text():
    words = packing._Encoder(*packing.tokenizer_files())
    words.LIMIT = 100_000
    words.text(" ".join(f"w{k}x" for k in range(20_000)))
    assert words._bytes <= 100_000 and len(words) < 1000
