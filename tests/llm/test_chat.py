"""Round trips through the formatted windows."""

import hashlib
import re

import pytest
from conftest import SMALL
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rosterloom.llm import chat
from rosterloom.llm.common import table
from rosterloom.llm.queries import FIXED_CONVERSATION, op9_chat_windows

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn if turn is not None else -1, role or "", text or ""))
    out = []
    for c, own in by.items():
        own.sort()
        loss = "".join(t for _, r, t in own if r == "assistant")
        out.append((c, len(own), sha("".join(f"{r}\n{t}\n" for _, r, t in own)), len(loss), sha(loss)))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r)[:5] for r in op9_chat_windows(spark, SMALL).collect()), key=str)
    assert got == expected([*rows, *FIXED_CONVERSATION])


ODD = [(1, 0, "system", "Be brief. <|im_start|>"), (1, 1, "user", "a" * 900), (1, 2, "assistant", "b\\<|im_end|>\n" * 30), (1, 3, "user", None),
       (1, 4, "assistant", "c" * 9000), (1, 5, "user", "<\\|<|\\|\\"), (1, 6, "assistant", "\n\n"), (2, 0, "assistant", "first"), (2, 0, "assistant", "first"),
       (2, None, None, "no turn"), (None, 1, "user", "nobody"), (None, 2, "assistant", "é\U0001F600"), (3, 0, "ro\nle<|", "x<\\~y"), (3, 1, "assistant", ""), (4, 0, "system", "only")]


@pytest.mark.parametrize("budget", [chat.Budget(), chat.Budget(tokens=20, history_turns=3, history_tokens=10_000, block=2), chat.Budget(tokens=5, history_turns=1, history_tokens=0, block=1)])
def test_odd_rows(spark, budget):
    rows = spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("x") for c in ("pos", "tokens", "window", "before", "block", "repeated")})
    windows = chat.windows(rows, budget)
    got = []
    for r in chat.read_back(windows).collect():
        turns = "".join(f"{t['role']}\n{t['text']}\n" for t in r["turns"])
        got.append((r["conv_id"], len(r["turns"]), sha(turns), len(r["loss_text"]), sha(r["loss_text"])))
    assert sorted(got, key=str) == expected(ODD)
    for w in windows.collect():
        assert w["formatted"].count(chat.START) == w["formatted"].count(chat.END)
        masked = [w["formatted"][x["first"]:x["last"]] for x in w["loss"]]
        assert all(chat.START not in m and chat.END not in m for m in masked)


def test_windows_keep_the_budget_and_the_system_turn(spark):
    rows = [(1, k, "system" if k == 0 else ("user", "assistant")[k % 2 == 0], f"turn {k} " + "x" * (37 * k % 200)) for k in range(60)]
    budget = chat.Budget(tokens=100, history_turns=2, history_tokens=60)
    windows = sorted(chat.windows(spark.createDataFrame(rows, SCHEMA), budget).collect(), key=lambda w: w["window"])
    assert len(windows) > 10
    for k, w in enumerate(windows):
        own = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", w["formatted"], re.S)
        assert own[0] == ("system", "turn 0 ")
        new = own[w["n_repeated"]:]
        assert len(new) == 1 or sum(-(-len(t) // 4) + 4 for _, t in new) <= budget.tokens
        history = own[1:w["n_repeated"]] if k else []
        assert len(history) <= 2 and sum(-(-len(t) // 4) + 4 for _, t in history) <= 60
        assert [w["formatted"][x["first"]:x["last"]] for x in w["loss"]] == [t for r, t in new if r == "assistant"]


def test_empty_table(spark):
    assert chat.read_back(chat.windows(spark.createDataFrame([], SCHEMA))).collect() == []


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="<|\\~\nim_startend> a", max_size=12), min_size=1, max_size=30))
def test_escape_is_reversible(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    row = frame.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"),
                       chat.unescape_role(chat.escape_role(F.col("t"))).alias("r")).collect()
    assert all(r["t"] == r["u"] == r["r"] and "<|" not in r["e"] for r in row)


def test_no_python_in_the_plan(spark):
    windows = chat.windows(table(spark, SMALL, "conversations"))
    assert not re.search("Python|Pandas|Arrow", chat.read_back(windows)._jdf.queryExecution().toString())
