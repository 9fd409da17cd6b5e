"""Findings against Python's own regular expressions, and the ledger's increments."""

import hashlib
import re

from conftest import SMALL
from fixtures import ODD, documents, widened
from pyspark.sql import functions as F

from rosterloom.llm import secrets
from rosterloom.llm.common import new_folder, table
from rosterloom.llm.queries import op3_secret_scan

ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def brute(text):
    text = text or ""
    hits = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    hits += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    hits += [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= 32]
    hits.sort()
    listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in hits)
    return (*(sum(h[3] == k for h in hits) for k in ("assign", "access", "hex")), hashlib.sha256(listed.encode()).hexdigest())


def test_query_equals_brute_force(spark):
    larger = SMALL.replace("0.001", "0.01")
    docs = {r["doc_id"]: r["text"] for r in table(spark, larger, "documents").collect()}
    rows = op3_secret_scan(spark, larger).collect()
    assert len(rows) == len(docs) and any(r["n_hex"] for r in rows)
    for r in rows:
        assert tuple(r)[1:5] == brute(docs[r["doc_id"]])


HARD = ["password: token = abcdefgh", "TOKEN='abcdefgh' é\U0001F600 api_key=\"12345678\"apikey=1234567", "AKIAABCDAKIA" + "Z" * 20 + " AKIA AKIAB AKIA234567890ABC",
        "x" + "0123456789abcdef" * 3 + " secret=" + "ab" * 20, "password:" * 50, "token = a=b=c=d=e secret:secret:secret", "ſecret=abcdefgh Toⓚen=abcdefgh toKen=abcdefgh",
        "passwd \"=\n abcdefgh", "hex " + "g".join(["f" * 31, "e" * 32, "0" * 33])]


def test_odd_and_hard_texts(spark):
    rows = [*ODD, *((100 + k, t) for k, t in enumerate(HARD))]
    found = secrets.scan_documents(widened(documents(spark, rows)))
    got = []
    for r in found.collect():
        base = [f for f in r["findings"] if f["kind"] in ("assign", "access", "hex")]
        listed = ",".join(f"{f['kind']}:{f['first']}:{f['last']}" for f in base)
        got.append((r["doc_id"], hashlib.sha256(listed.encode()).hexdigest()))
    assert sorted(got, key=str) == sorted(((r[0], brute(r[1])[3]) for r in rows), key=str)


def test_empty_table(spark):
    assert secrets.scan_documents(documents(spark, [])).collect() == []


def test_ledger_scans_only_the_unseen(spark):
    path = new_folder(spark, "ledger")
    rules = (secrets.Rule("hex", r"[0-9a-f]{32,}"),)
    ledger = secrets.BlobLedger(spark, path, rules)
    one = "f" * 40
    first = spark.createDataFrame([("a", one), ("b", one), ("c", "none"), ("d", None)], "path string, text string")
    ledger.scan(first)
    stored = lambda: spark.read.parquet(path)
    assert stored().count() == 3
    second = spark.createDataFrame([("a", one + " more"), ("e", one)], "path string, text string")
    addressed = ledger.scan(second)
    assert stored().count() == 4
    found = {r["path"]: len(r["findings"]) for r in ledger.findings(addressed).collect()}
    assert found == {"a": 1, "e": 1}
    # A changed rule is a new pair for every blob that comes by again; its old findings no longer count.
    changed = secrets.BlobLedger(spark, path, (secrets.Rule("hex", r"[0-9a-f]{41,}", version=2),))
    assert {r["path"]: len(r["findings"]) for r in changed.findings(changed.scan(first)).collect()} == {"a": 0, "b": 0, "c": 0, "d": 0}
    assert stored().count() == 7
    ledger.scan(first)
    assert stored().count() == 7


def test_more_rules_add_spans(spark):
    text = "x -----BEGIN RSA PRIVATE KEY----- y"
    row = secrets.scan_documents(documents(spark, [(1, text)])).first()
    assert [(f["kind"], f["first"], f["last"]) for f in row["findings"]] == [("pem", 2, 33)]


def test_no_python_in_the_plan(spark):
    frame = op3_secret_scan(spark, SMALL)
    assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().toString())
    assert frame.select(F.count("*")).columns
