"""Small tables with the cases every operator must stand."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that clash with names the operators use inside.
CLASHING = ("piece", "length", "words", "text_", "_quality", "_parts", "_lines", "_node", "_key", "blob", "findings", "fp", "ids", "k", "h", "spans")


def documents(spark, rows):
    """Rows as (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def widened(docs):
    """With columns of clashing names, holding nulls."""
    from pyspark.sql import functions as F
    return docs.withColumns({c: F.lit(None).cast("string") for c in CLASHING})


LONG = " ".join(f"w{i % 997}x{i}" for i in range(12000))

ODD = [(1, None), (2, ""), (3, "one"), (4, "   \n\t \n"), (5, "Same words in this text, twice over."),
       (6, "Same words in this text, twice over."), (6, "Same words in this text, twice over."), (None, "No id here."),
       (None, None), (7, LONG), (8, "é ü 漢字 \U0001F600 mixed\r\nlines  and   spaces \n\n end "), (9, "<|endoftext|> a<|endoftext|>b")]


def rows_of(frame, *names):
    return [tuple(r[n] for n in names) for r in frame.collect()]
