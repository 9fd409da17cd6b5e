"""Quality rules: base counts, and divergence from language references.

A document's histograms of character classes and of its language's common words are
compared with the mean histograms of that language by Jensen-Shannon distance. Only
DataFrame functions are used. Each document is one row from start to end, so nothing is shuffled but the
sums behind the references: a row for each reference and task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rosterloom.llm.common import bound, free_name, kept

SPACE, SYMBOLS = r"[\x20\x09-\x0D]+", r"[#*$%&|<>]+"

# Frequent function words of each language, as parameters of the references.
COMMON_WORDS = {
    "de": ("der", "die", "das", "und", "in", "zu", "den", "mit", "von", "für", "ist", "im", "nicht", "ein", "eine",
           "auf", "dem", "sich", "auch", "als"),
    "en": ("the", "of", "and", "to", "a", "in", "is", "it", "that", "for", "was", "on", "as", "with", "by", "he",
           "at", "from", "be", "this"),
    "es": ("el", "la", "de", "que", "y", "en", "los", "se", "del", "las", "por", "un", "para", "con", "no", "una",
           "su", "al", "es", "lo"),
    "fr": ("le", "la", "de", "et", "les", "des", "en", "un", "une", "du", "que", "est", "dans", "qui", "pour", "au",
           "sur", "pas", "par", "il"),
}


@dataclass(frozen=True)
class Rules:
    """Limits; distances are square roots of base-2 Jensen-Shannon divergences, from 0 to 1.

    Few counts lie far from any reference by chance, by the order of the inverse square root of
    their number: a limit is its constant plus the slack over the root of the length.
    """

    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    min_chars_for_classes: int = 200
    min_words_for_common: int = 60
    max_class_distance: float = 0.2
    class_slack: float = 2.0
    max_common_distance: float = 0.13
    common_slack: float = 1.7
    min_documents: int = 10  # a language with fewer that pass the base rules has no reference


def _without(text: Column, pattern: str) -> Column:
    return F.char_length(F.regexp_replace(text, pattern, ""))


def _repeat_words(words: Column, window: int) -> Column:
    """Words inside windows that occur twice or more.

    Window hashes are compared first. Only a text with equal hashes has them sorted, with their places, and
    neighbours of equal hash are compared word by word.
    """
    def covered(w: Column, hashes: Column) -> Column:
        def repeated(s: Column) -> Column:
            def same(j: Column, k: Column) -> Column:
                x, y = F.get(s, j), F.get(s, k)
                return F.coalesce((x["h"] == y["h"]) & (F.slice(w, x["i"], window) == F.slice(w, y["i"], window)), F.lit(False))
            return F.filter(F.transform(s, lambda x, j: F.when(same(j, j - 1) | same(j, j + 1), x["i"])),
                            lambda i: i.isNotNull())

        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i")))
        return F.aggregate(
            F.sort_array(bound(F.sort_array(placed), repeated)),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda a, i: F.struct((a["n"] + i + window - F.greatest(a["end"], i)).alias("n"),
                                  (i + window).alias("end")), lambda a: a["n"])

    def of(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(w) - window + 1)
        hashes = F.transform(places, lambda i: F.xxhash64(*(w[i - 1 + k] for k in range(window))))
        return F.when(F.size(w) <= window, F.lit(0)).otherwise(bound(hashes, lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(w, h))))

    return bound(words, of).cast("long")


def features(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` with a struct column of counts, whose name is the last column.

    ``classes``: characters that are lower-case letters, other letters, digits, white space, the symbols of
    :data:`SYMBOLS`, other punctuation, and anything else. ``common``: occurrences of each
    of the language's common words (any case, by letters alone), then all other words. A null text is empty.
    """
    name, parts = free_name(docs, "_quality"), free_name(docs, "_parts")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    cut = docs.withColumn(parts, F.struct(
        F.char_length(text).alias("n_chars"),
        F.array_remove(F.split(text, SPACE), "").alias("words"),
        # What is left is short, so that the classes below cost little.
        F.regexp_replace(text, "[a-zß-öø-ÿ\\x20\\x09-\\x0D]+", "").alias("rest"),
        bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        F.when(F.col("lang").isin(*COMMON_WORDS), F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), ""))
        .otherwise(F.array().cast("array<string>")).alias("letters")))
    p = F.col(parts)
    words, rest, n_rest = p["words"], p["rest"], F.char_length(p["rest"])
    word_chars = F.char_length(F.array_join(words, ""))
    symbols = n_rest - _without(rest, SYMBOLS)
    digits = n_rest - _without(rest, r"\p{Nd}+")
    capitals = n_rest - _without(rest, r"[\p{L}&&\P{Ll}]+")
    small = n_rest - _without(rest, r"\p{Ll}+")
    marks = n_rest - _without(rest, r"[\p{P}\p{S}&&[^#*$%&|<>]]+")
    classes = F.array(word_chars - n_rest + small, capitals, digits, p["n_chars"] - word_chars, symbols, marks,
                      n_rest - symbols - digits - capitals - small - marks)

    def common(letters: Column) -> Column:
        # Words of no list go first; the rest is short enough to be searched for each word of the language.
        listed = sorted({w for own in COMMON_WORDS.values() for w in own})
        few = F.concat(F.lit(" "), F.array_join(F.filter(letters, lambda w: w.isin(*listed)), "  "), F.lit(" "))

        def counts(padded: Column) -> Column:
            chosen = F.lit(None).cast("array<double>")
            for lang, own in COMMON_WORDS.items():
                each = [(F.char_length(padded) - F.char_length(F.replace(padded, F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)
                        for w in own]
                chosen = F.when(F.col("lang") == lang, F.array(*each)).otherwise(chosen)
            return chosen
        return bound(bound(few, counts), lambda c: F.when(c.isNotNull(), F.concat(c, F.array(
            F.size(letters) - F.aggregate(c, F.lit(0.0), lambda a, x: a + x)))))

    n_repeat = _repeat_words(words, rules.window)
    return cut.withColumn(name, F.struct(
        F.size(words).cast("long").alias("n_words"), word_chars.cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"), p["n_dup_lines"].cast("long").alias("n_dup_lines"),
        n_repeat.alias("n_repeat_words"), classes.cast("array<double>").alias("classes"),
        bound(p["letters"], common).alias("common"))).drop(parts)


def _share(counts: Column) -> Column:
    return bound(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x),
                 lambda n: F.transform(counts, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0))))


def references(counted: DataFrame, name: str, rules: Rules = Rules()) -> dict[str, dict[str, list[float]]]:
    """Mean shares per value of ``lang`` over all its documents that pass the base rules.

    One row per language with enough of these comes to the driver. ``common`` is empty for languages without a list.
    """
    q = F.col(name)
    sound = counted.where(~base_failed(q, rules) & F.col("lang").isNotNull()).select(
        "lang", _share(q["classes"]).alias("classes"), _share(q["common"]).alias("common"))
    longest = 1 + max(map(len, COMMON_WORDS.values()))
    sums = sound.groupBy("lang").agg(
        F.count("*").alias("n"), *(F.sum(F.col("classes")[k]).alias(f"c{k}") for k in range(7)),
        *(F.sum(F.get("common", F.lit(k))).alias(f"w{k}") for k in range(longest))).where(
        F.col("n") >= rules.min_documents).collect()
    return {r["lang"]: {"classes": [r[f"c{k}"] / r["n"] for k in range(7)],
                        "common": [r[f"w{k}"] / r["n"] for k in range(1 + len(COMMON_WORDS[r["lang"]]))] if r["lang"] in COMMON_WORDS else []}
            for r in sums}


def js_distance(counts: Column, reference: list[float] | list[Column]) -> Column:
    """Square root of the base-2 Jensen-Shannon divergence of the counts' shares from ``reference``."""
    def of(p: Column) -> Column:
        half = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
        total = F.lit(0.0)
        for k, r in enumerate(reference):
            x, y = p[k], r if isinstance(r, Column) else F.lit(float(r))
            total = total + half(x, y) + half(y, x)
        return F.sqrt(F.greatest(total / 2, F.lit(0.0)))
    return bound(_share(counts), of)


def base_failed(q: Column, rules: Rules = Rules()) -> Column:
    return ((q["n_words"] < rules.min_words)
            | (100 * q["n_repeat_words"] > rules.max_repeat_percent * q["n_words"]))


def judged(docs: DataFrame, rules: Rules = Rules(), columns: list[str] | None = None) -> tuple[DataFrame, str]:
    """Each row of ``docs`` (its ``columns``) with a struct of counts, distances and verdict.

    Needs ``text`` and ``lang``. Returns the frame and the struct's name. ``base_failed``: too
    few words, or too many in repeated windows. ``kept`` is false for those, and where a distance exceeds its limit;
    a distance is null, and objects to nothing, below its minimum length, in a null language or one that has too few documents for a
    reference, or, for common words, in a language without a list. Null texts are empty, so they fail.
    Every other language meets its own class reference. Repeated rows are judged alike. An empty table gives none.
    """
    counted = features(docs, rules)
    name = counted.columns[-1]
    counted = kept(counted.select(*(f"`{c}`" for c in dict.fromkeys([*(columns or docs.columns), "lang", name]))), "quality")
    known = references(counted, name, rules)
    q, by_class, by_word = F.col(name), F.lit(None).cast("double"), F.lit(None).cast("double")
    unlisted = sorted(known.keys() - COMMON_WORDS.keys())
    if unlisted:
        own = F.create_map(*(c for lang in unlisted for c in (
            F.lit(lang), F.array(*(F.lit(float(x)) for x in known[lang]["classes"])))))
        by_class = bound(F.try_element_at(own, F.col("lang")), lambda r: F.when(
            r.isNotNull(), js_distance(q["classes"], [r[k] for k in range(7)])))
    for lang in sorted(known.keys() & COMMON_WORDS.keys()):
        by_class = F.when(F.col("lang") == lang, js_distance(q["classes"], known[lang]["classes"])).otherwise(by_class)
        by_word = F.when(F.col("lang") == lang, js_distance(q["common"], known[lang]["common"])).otherwise(by_word)
    n_chars = F.aggregate(q["classes"], F.lit(0.0), lambda a, x: a + x)
    full = q.withField("class_distance", F.when(n_chars >= rules.min_chars_for_classes, by_class))
    full = full.withField("common_distance", F.when(q["n_words"] >= rules.min_words_for_common, by_word))
    full = full.withField("base_failed", base_failed(q, rules))
    with_distances = counted.withColumn(name, full)
    q = F.col(name)
    n_chars = F.aggregate(q["classes"], F.lit(0.0), lambda a, x: a + x)
    near = lambda distance, most, slack, n: F.coalesce(distance <= most + slack / F.sqrt(n), F.lit(True))
    fine = (~q["base_failed"] & near(q["class_distance"], rules.max_class_distance, rules.class_slack, n_chars)
            & near(q["common_distance"], rules.max_common_distance, rules.common_slack, q["n_words"]))
    return with_distances.withColumn(name, q.withField("kept", fine)), name


def filtered(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    frame, name = judged(docs, rules)
    return frame.where(F.col(name)["kept"]).select(*(f"`{c}`" for c in docs.columns))
