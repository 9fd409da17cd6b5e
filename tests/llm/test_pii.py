"""Surrogates: type, format, gender, script, distinctness, coreference."""

import re

import pytest
from conftest import SMALL
from fixtures import ODD, documents, widened
from pyspark.sql import functions as F

from rosterloom.llm import pii
from rosterloom.llm.common import table
from rosterloom.llm.queries import op8_pii_surrogates

PLAIN = {"email": re.compile(r"[A-Za-z0-9._]+@[a-z0-9.]+\.com"), "phone": re.compile(r"\+1 \(\d{3}\) \d{3}-\d{4}"),
         "card": re.compile(r"(?<![\w.])\d{16}(?!\w)"), "ip": re.compile(r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w])")}


def replaced(spark, texts, key="k"):
    rows = pii.pseudonymize(documents(spark, [(k, t) for k, t in enumerate(texts)]), key).collect()
    return {r["doc_id"]: r for r in rows}


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits)) % 10 == 0


def test_nothing_planted_survives(spark):
    larger = SMALL.replace("0.001", "0.01")
    docs = {r["doc_id"]: r["text"] for r in table(spark, larger, "documents").collect()}
    rows = op8_pii_surrogates(spark, larger).collect()
    assert len(rows) == len(docs)
    originals = {kind: {m for t in docs.values() for m in p.findall(t)} for kind, p in PLAIN.items()}
    for kind in ("email", "phone", "card"):
        assert originals[kind], kind
    for r in rows:
        for kind, p in PLAIN.items():
            assert not set(p.findall(r["text"])) & originals[kind], (kind, r["doc_id"])
        if not r["n_entities"]:
            assert r["text"] == docs[r["doc_id"]]
        else:
            assert r["text"] != docs[r["doc_id"]]


def test_types_and_formats(spark):
    texts = ["Write to Anna.B7@Mail.example.com now.", "call +1 (771) 555-1655, or 771-555-1655", "card 4111 1111 1111 1111 ok", "card 4785380592391139.",
             "host 10.0.0.255 up", "ssn 123-45-6789 x", "IBAN DE89 3704 0044 0532 0130 00 end"]
    rows = replaced(spark, texts)
    assert [rows[k]["entities"][0]["kind"] for k in range(7)] == ["email", "phone", "card", "card", "ip", "ssn", "iban"]
    for k, pattern in enumerate([r"Write to [a-z]{4}\.[a-z]\d@[a-z]{6}\d\d\.example now\.", r"call \+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}, or [2-9]\d\d-[2-9]\d\d-\d{4}",
                                 r"card 4\d{3} \d{4} \d{4} \d{4} ok", r"card 4\d{15}\.", r"host \d+\.\d+\.\d+\.\d+ up", r"ssn \d{3}-\d\d-\d{4} x", r"IBAN DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d end"]):
        assert re.fullmatch(pattern, rows[k]["text"]), rows[k]["text"]
        for e in rows[k]["entities"]:
            assert texts[k][e["first"]:e["last"]] != e["surrogate"] and e["surrogate"] in rows[k]["text"]
    assert luhn(rows[2]["entities"][0]["surrogate"])


def test_names_keep_gender_script_and_format(spark):
    texts = ["Mr. John Smith met Mrs Smith and MRS", "Frau MÜLLER kam.", "Господин Иванов и Госпожа Иванова", "Κύριος Παπαδόπουλος"]
    rows = replaced(spark, texts)
    first = re.fullmatch(r"Mr\. ([A-Z][a-z]+) ([A-Z][a-z]+) met Mrs ([A-Z][a-z]+) and MRS", rows[0]["text"])
    assert first and first[2] == first[3] and "Smith" not in rows[0]["text"] and "John" not in rows[0]["text"]
    assert first[1].endswith(tuple(pii.SYLLABLES["Latin"][1]["m"].split()))
    assert re.fullmatch(r"Frau [A-Z]+ kam\.", rows[1]["text"])
    assert re.fullmatch(r"Господин [А-Яа-я]+ и Госпожа [А-Яа-я]+", rows[2]["text"]) and "Иванов" not in rows[2]["text"]
    assert re.fullmatch(r"Κύριος [Α-Ωα-ως]+", rows[3]["text"])


def test_coreference_and_key(spark):
    texts = ["a@b.com and A@B.COM and a@b.com", "again a@b.com, phone (771) 555-1655", "771 555-1655"]
    rows = replaced(spark, texts)
    one = [e["surrogate"] for e in rows[0]["entities"]]
    assert one[0] == one[2] == one[1].lower() and one[1].isupper() and rows[1]["entities"][0]["surrogate"] == one[0]
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(rows[1]["entities"][1]["surrogate"]) == digits(rows[2]["entities"][0]["surrogate"])
    assert replaced(spark, texts, "other")[0]["text"] != rows[0]["text"]


def test_collisions_are_resolved(spark, monkeypatch):
    """With a thousand possible surrogates for eight hundred entities, all stay distinct, and none is an entity."""
    monkeypatch.setattr(pii, "surrogate", lambda key: F.concat(
        F.lit("s"), F.pmod(F.xxhash64(F.lit(key), "norm", "attempt"), F.lit(1000)).cast("string")))
    entities = spark.range(800).selectExpr("'x' AS kind", "concat('n', id) AS norm").unionByName(
        spark.range(20).selectExpr("'x' AS kind", "concat('s', id) AS norm"))
    rows = pii.mapping(entities, "k").collect()
    made = [r["made"] for r in rows]
    assert len(rows) == 820 and len(set(made)) == 820 and not {f"s{k}" for k in range(20)} & set(made)


def test_odd_rows(spark):
    rows = [*ODD, (30, "x@y.com " * 3000), (31, "a@b.com"), (31, "a@b.com")]
    result = pii.pseudonymize(widened(documents(spark, rows)), "k").collect()
    assert len(result) == len(rows)
    by = {r["doc_id"]: r for r in result}
    assert by[1]["text"] is None and by[2]["text"] == "" and by[7]["text"] == dict((r[0], r[1]) for r in rows)[7]
    assert len(by[30]["entities"]) == 3000 and len(set(by[30]["text"].split())) == 1
    assert len({r["text"] for r in result if r["doc_id"] == 31}) == 1
    assert pii.pseudonymize(documents(spark, []), "k").collect() == []


@pytest.mark.parametrize("text", ["version 1.2.3 of 12 items", "in 2024-01-02 at 12:30", "no mr here", "a@b", "1234567 1.2.3.4.5"])
def test_clean_texts_stay(spark, text):
    assert pii.pseudonymize(documents(spark, [(1, text)]), "k").first()["text"] == text


def test_no_python_in_the_plan(spark):
    frame = pii.pseudonymize(table(spark, SMALL, "documents"), "k")
    assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().toString())
