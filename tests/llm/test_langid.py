"""Held-out accuracy, and what a prediction may depend on."""

import zlib

import numpy as np
from conftest import SMALL
from fixtures import ODD, documents, widened

from rosterloom.llm import langid
from rosterloom.llm.common import table
from rosterloom.llm.queries import op2_language_id

LARGER = SMALL.replace("0.001", "0.01")


def test_held_out_accuracy(spark):
    lang = {r["doc_id"]: (r["lang"], r["text"]) for r in table(spark, LARGER, "documents").collect()}
    rows = op2_language_id(spark, LARGER).collect()
    assert len(rows) == len(lang)
    right, n = 0, 0
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if r["held_out"] and langid.has_letter(lang[r["doc_id"]][1]):
            n += 1
            right += r["lang_pred"] == lang[r["doc_id"]][0]
    assert n > 100 and right / n >= 0.97


SAMPLES = {"en": "the cat sat on the mat with that other cat of this house", "de": "der hund und die katze sind nicht im garten mit dem ball"}


def labelled(n=40):
    return [(k, " ".join(SAMPLES[lang].split()[(k + j) % 11] for j in range(9)), lang) for k in range(n) for lang in [("en", "de")[k % 2]]]


def test_odd_rows(spark):
    model = langid.fit(documents(spark, labelled()))
    rows = langid.predict(widened(documents(spark, [*ODD, (50, SAMPLES["de"] * 9000), (51, "12 34 !!")])), model).collect()
    assert len(rows) == len(ODD) + 2
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["lang_pred"], r["score"]))
    assert by[1] == by[2] == by[4] == by[51] == {("und", 0.0)}
    assert {p for p, _ in by[50]} == {"de"} and len(by[6]) == 1


def test_predictions_read_only_the_text(spark):
    model = langid.fit(documents(spark, labelled()))
    one = documents(spark, [(1, SAMPLES["de"], "en"), (999, SAMPLES["de"], None)])
    assert len({(r["lang_pred"], r["score"]) for r in langid.predict(one, model).collect()}) == 1


def test_nothing_to_learn_from(spark):
    assert langid.fit(documents(spark, [])) is None
    assert langid.fit(documents(spark, [(1, None, "en"), (2, "text", None), (3, "!!", "en")])) is None
    assert [tuple(r) for r in langid.predict(documents(spark, [(1, "text")]), None).collect()] == [(1, "und", 0.0)]
    one = langid.fit(documents(spark, [(k, f"some text {k}", "en") for k in range(5)]))
    assert [r["lang_pred"] for r in langid.predict(documents(spark, [(1, "text")]), one).collect()] == ["en"]


def test_sample_is_bounded_per_language(spark):
    kernel = langid.Kernel(per_language=7)
    rows = langid.training_sample(documents(spark, labelled(100)), kernel).collect()
    assert sorted(r["lang"] for r in rows) == ["de"] * 7 + ["en"] * 7


def test_whole_texts_count():
    kernel = langid.Kernel()
    text = "ab " * 60000 + "zq"
    short = langid.presence(["ab ab zq"], kernel)
    assert np.array_equal(langid.presence([text], kernel), short)


def test_sample_stands_repeated_and_null_ids(spark):
    kernel = langid.Kernel(per_language=20)
    rows = [(1, f"{SAMPLES['en']} {k}", "en") for k in range(300)] + [(2, "always this", "en")] * 300
    rows += [(None, f"{SAMPLES['de']} {k}", "de") for k in range(30)]
    docs = documents(spark, rows)
    sample = [tuple(r) for r in langid.training_sample(docs, kernel).collect()]
    assert len(sample) == len(set(sample)) == 40
    model = langid.fit(docs, kernel)
    assert list(model.languages) == ["de", "en"] and len(model.landmarks) <= 40
    got = langid.predict(documents(spark, [(1, SAMPLES["de"]), (2, SAMPLES["en"])]), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {1: "de", 2: "en"}
