"""Chat formatting in budgeted windows.

Prefix sums of turn tokens assign every turn to a turn-aligned span. Each span becomes one
formatted window: the conversation's leading system turn, a limited number of the turns before the span
as history, then the span. Only assistant turns of the span itself are under the loss
mask; what a window repeats is masked. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterloom.llm.common import kept

# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
_TURN = "array<struct<role:string,text:string,repeated:boolean>>"


@dataclass(frozen=True)
class Budget:
    """``tokens`` of new turns in a window; of history at most ``history_turns`` turns of ``history_tokens`` in all."""

    tokens: int = 1024
    history_turns: int = 2
    history_tokens: int = 256
    block: int = 256


def escape(text: Column) -> Column:
    """Backslashes double; one goes into ``<|``, and a line break becomes ``<\\~`` in roles only.

    Afterwards ``<|`` occurs nowhere, and a single backslash only where one was put.
    """
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\~"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\~"), F.lit("\n")))


def count_tokens(text: Column) -> Column:
    """Length by a rule of thumb: a token per four characters begun, and four for the turn's marks."""
    return (F.ceil(F.char_length(text) / 4) + 4).cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text``, with null roles and texts as empty strings."""
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def with_prefix_sums(rows: DataFrame, budget: Budget) -> DataFrame:
    """Adds ``tokens``, ``before`` (the tokens of all earlier turns of the conversation) and ``pos``, the
    place from 0: by turn, nulls first, then by role and text.

    Sums run inside blocks of turn numbers and then over the blocks, so a
    conversation that holds most rows is spread over its blocks.
    """
    sized = rows.withColumn("tokens", count_tokens(F.col("text"))).withColumn(
        "block", F.floor(F.coalesce("turn", F.lit(-1)) / budget.block))
    per_block = sized.groupBy("conv_id", "block").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select("conv_id", "block", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t0"),
                               F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = sized.withColumn("t1", F.sum("tokens").over(upto) - F.col("tokens")).withColumn("n1", F.row_number().over(inside) - 1)
    l, o = local.alias("l"), offsets.alias("o")
    return (l.join(o, (F.col("l.block") == F.col("o.block")) & F.col("l.conv_id").eqNullSafe(F.col("o.conv_id")))
            .select("l.*", (F.col("t0") + F.col("t1")).alias("before"), (F.col("n0") + F.col("n1")).alias("pos"))
            .drop("t1", "n1", "block"))


def windows(conversations: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """Formatted windows: ``conv_id, window, formatted, loss``.

    ``window`` orders a conversation's windows. A turn that lies between two multiples of the
    budget joins the span of those; one that crosses a multiple is a span of its own, so only a
    single turn longer than the budget exceeds it. ``loss`` lists half-open code point ranges of
    ``formatted`` that hold the escaped texts of new assistant turns. A leading turn of role
    system is repeated at the head of every later window, history turns after it. Null conv_ids are one
    conversation; repeated rows are turns of their own; a conversation of any roles is formatted.
    """
    rows = with_prefix_sums(turns(conversations), budget)
    first, last = F.floor(F.col("before") / budget.tokens), F.floor((F.col("before") + F.col("tokens") - 1) / budget.tokens)
    # Whole multiples are spans 2k, crossing turns 2k + 1, in the order of the turns.
    spans = kept(rows.withColumn("window", F.when(first == last, 2 * first).otherwise(2 * first + 1)), "turns")
    new = spans.select("conv_id", "window", "pos", "role", "text", F.lit(False).alias("repeated"))
    ranges = spans.groupBy("conv_id", "window").agg(F.min("pos").alias("head"))
    # A turn is history for the windows that begin within history_turns after it: found by position, not by pairs.
    heads = ranges.where("head > 0").select(
        "conv_id", "window", "head", F.explode(F.sequence(F.lit(1), F.lit(budget.history_turns))).alias("back"))
    want = heads.select("conv_id", "window", "back", (F.col("head") - F.col("back")).alias("pos")).where("pos >= 0")
    s, w = spans.alias("s"), want.alias("w")
    past = s.join(w, F.col("s.conv_id").eqNullSafe(F.col("w.conv_id")) & (F.col("s.pos") == F.col("w.pos"))).where(
        (F.col("s.pos") > 0) | (F.col("s.role") != "system")).select(
        "s.conv_id", "w.window", "s.pos", "s.role", "s.text", "s.tokens", "w.back")
    running = F.sum("tokens").over(Window.partitionBy("conv_id", "window").orderBy("back"))
    past = past.withColumn("sum", running).where(F.col("sum") <= budget.history_tokens)
    lead = spans.where("pos = 0 AND role = 'system'").select("conv_id", "pos", "role", "text").alias("s")
    h = ranges.where("head > 0").alias("h")
    system = lead.join(h, F.col("s.conv_id").eqNullSafe(F.col("h.conv_id"))).select(
        "s.conv_id", "h.window", "s.pos", "s.role", "s.text")
    again = past.select("conv_id", "window", "pos", "role", "text").unionByName(system).withColumn("repeated", F.lit(True))
    grouped = new.unionByName(again).groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("pos", "role", "text", "repeated"))).alias("turns"))
    head = lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))
    parts = grouped.select("conv_id", "window", F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), escape(t["text"]).alias("body"),
        ((t["role"] == "assistant") & ~t["repeated"]).alias("loss"), t["repeated"].alias("repeated"))).alias("parts"))
    close = len(END) + 1
    placed = F.aggregate(
        "parts", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,last:int>>").alias("loss")),
        lambda a, p: F.struct(
            (a["at"] + F.char_length(p["head"]) + F.char_length(p["body"]) + close).alias("at"),
            F.when(p["loss"], F.array_append(a["loss"], F.struct(
                (a["at"] + F.char_length(p["head"])).alias("first"),
                (a["at"] + F.char_length(p["head"]) + F.char_length(p["body"])).alias("last")))).otherwise(a["loss"]).alias("loss")),
        lambda a: a["loss"])
    body = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))), "")
    n_repeated = F.size(F.filter("parts", lambda p: p["repeated"]))
    return parts.select("conv_id", "window", body.alias("formatted"), placed.alias("loss"), n_repeated.alias("n_repeated"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted window, unescaped: ``array<struct<role, text>>``."""
    chunks = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1_000_000_000)
    return F.transform(chunks, lambda c: F.struct(
        unescape_role(F.substring_index(c, "\n", 1)).alias("role"),
        unescape(F.substring(c, F.char_length(F.substring_index(c, "\n", 1)) + 2,
                             F.char_length(c) - F.char_length(F.substring_index(c, "\n", 1)) - 2 - len(END))).alias("text")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its windows alone: ``conv_id, turns, loss_text, formatted_chars``.

    A window begins with its ``n_repeated`` repeated turns, which are skipped; the
    loss ranges cut the targets out of the formatted text.
    """
    new = F.slice(parse(F.col("formatted")), F.col("n_repeated") + 1, 1_000_000_000)
    cut = F.array_join(F.transform("loss", lambda r: unescape(
        F.substring(F.col("formatted"), r["first"] + 1, r["last"] - r["first"]))), "")
    per = formatted.select("conv_id", "window", new.alias("turns"), cut.alias("loss_text"),
                           F.char_length("formatted").cast("long").alias("n"))
    whole = per.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "turns", "loss_text"))).alias("all"), F.sum("n").alias("formatted_chars"))
    return whole.select("conv_id", F.flatten(F.transform("all", lambda w: w["turns"])).alias("turns"),
                        F.array_join(F.transform("all", lambda w: w["loss_text"]), "").alias("loss_text"), "formatted_chars")
