"""Counts against plain Python, distances against the textbook formula."""

import math
import re
from collections import Counter

from conftest import SMALL
from fixtures import ODD, documents, widened

from rosterloom.llm import quality
from rosterloom.llm.common import table
from rosterloom.llm.queries import op5_quality_rules

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    times, inside = Counter(grams), set()
    for k, g in enumerate(grams):
        if times[g] > 1:
            inside.update(range(k, k + 5))
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed)


def test_query_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").collect()}
    rows = op5_quality_rules(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r)[1:7] == brute_counts(docs[r["doc_id"]]), r["doc_id"]
        assert r["kept"] in (True, False) and not (r["base_failed"] and r["kept"])


def test_clean_documents_stay(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SMALL.replace("0.001", "0.01"), "labels").collect()}
    rows = [r for r in op5_quality_rules(spark, SMALL.replace("0.001", "0.01")).collect() if r["doc_id"] in labels]
    good = [r for r in rows if labels[r["doc_id"]] == 1]
    assert sum(r["kept"] or r["base_failed"] for r in good) / len(good) >= 0.99
    bad = [r for r in rows if labels[r["doc_id"]] == 0]
    assert sum(not r["kept"] for r in bad) / len(bad) >= 0.9


def test_odd_rows(spark):
    rows = [*ODD, (10, "a b c d e a b c d e"), (11, "x\nx\n \n\ny\nx"), (12, "w " * 5000), (13, "#*$ %& |<> " * 3)]
    frame, name = quality.judged(widened(documents(spark, rows)))
    got = sorted((tuple(r[name][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
                  for r in frame.collect()))
    assert got == sorted(brute_counts(r[1]) for r in rows)


def test_empty_table_and_null_language(spark):
    assert quality.judged(documents(spark, []))[0].collect() == []
    rows = [(1, "ten words are here so that the base rules pass " * 1, None), (2, "other ten words are here so that base rules pass", "xx")]
    frame, name = quality.judged(documents(spark, rows))
    assert [r[name]["kept"] for r in frame.collect()] == [True, True]


def test_filter_keeps_columns(spark):
    docs = widened(documents(spark, ODD))
    out = quality.filtered(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [7]


def test_distance(spark):
    def shares(x):
        return [v / sum(x) for v in x]

    def expected(p, q):
        mid = [(a + b) / 2 for a, b in zip(p, q)]
        kl = lambda a: sum(x * math.log2(x / m) for x, m in zip(a, mid) if x)
        return math.sqrt((kl(p) + kl(q)) / 2)
    counts, reference = [3.0, 0.0, 5.0, 1.0], [0.25, 0.25, 0.5, 0.0]
    frame = spark.createDataFrame([(counts,), ([0.0, 0.0, 0.0, 1.0],)], "c array<double>")
    got = [r[0] for r in frame.select(quality.js_distance(frame["c"], reference)).collect()]
    assert abs(got[0] - expected(shares(counts), reference)) < 1e-9 and abs(got[1] - 1) < 1e-9


def test_divergent_text_is_rejected(spark):
    good = [(k, "the cat and the dog of it was in a house that is for him to be with as on by he at from this " * 1 + f"n{k} "
             + " ".join(f"word{'abcdefghij'[j % 10]}{'klmnop'[j % 6]}{chr(97 + (k * 7 + j) % 26)}" for j in range(80))) for k in range(30)]
    bad = (99, " ".join(f"{k * 7919 % 100003}" for k in range(200)))
    frame, name = quality.judged(documents(spark, [*good, bad]))
    kept = {r["doc_id"]: r[name]["kept"] for r in frame.collect()}
    assert not kept[99] and all(kept[k] for k in range(30))


def test_no_python_in_the_plan(spark):
    frame, _ = quality.judged(table(spark, SMALL, "documents"))
    plan = frame._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_each_language_meets_its_own_reference(spark):
    """Clean texts of another script stay in a mostly Latin corpus, junk of that language goes; few or no labels object to nothing."""
    latin = [(k, " ".join(f"word{'abcdefghij'[j % 10]}{chr(97 + (k * 7 + j) % 26)}{chr(97 + j // 3 % 26)}" for j in range(80)), "en") for k in range(60)]
    other = lambda k: " ".join("".join(chr(0x4E00 + (k * 131 + j * 17 + i * 7) % 4000) for i in range(4)) for j in range(80))
    rows = [*latin, *((100 + k, other(k), "zh") for k in range(15)), *((200 + k, other(50 + k), "xx") for k in range(3)), (300, other(70), None),
            (400, " ".join(f"{k * 7919 % 100003}" for k in range(200)), "zh")]
    frame, name = quality.judged(documents(spark, rows))
    got = {r["doc_id"]: r[name] for r in frame.collect()}
    assert [k for k in got if not got[k]["kept"] and k >= 100] == [400]
    assert got[100]["class_distance"] is not None and got[200]["class_distance"] is None and got[300]["class_distance"] is None
