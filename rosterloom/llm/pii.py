"""Personal data: detection and keyed surrogates, with DataFrame functions only.

Each entity is normalised, so that its spellings are one entity throughout the corpus. A keyed hash
makes its surrogate: digits for digits, letters for letters, valid octets, check digits
that stay valid, names of the same gender and script. All distinct entities meet in one
mapping, in which no two share a surrogate and no surrogate is itself an entity of the corpus; who
loses a collision tries again with the next attempt number. The mapping is joined
back on the entity, so the same one reads the same everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rosterloom.llm.common import bound, kept
from rosterloom.llm.spans import matches

# Honorifics by gender.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία")
# Syllables from which names are made: script, then beginnings, and endings by gender.
SYLLABLES = {
    "Latin": ("ba be bo da de do fa fe ka ke la le lo ma me mi na ne ra re ro sa se ta te to va ve",
              {"m": "n r s k t", "f": "a ia ina ela", "x": "y el or en", "family": "son ner mann ley ton er"}),
    "Cyrillic": ("ба бе бо да де до ва ве ка ке ла ле ло ма ме ми на не ра ре ро са се та те",
                 {"m": "н р с к т", "f": "а ия ина ела", "x": "ей ий", "family": "ов ин ский ко"}),
    "Greek": ("βα βε βο δα δε δο κα κε λα λε λο μα με μι να νε ρα ρε ρο σα σε τα τε",
              {"m": "ος ης ας", "f": "α η ια", "x": "ι ω", "family": "ιδης ακος ου"}),
}
_NAME = r"\p{Lu}[\p{L}'’-]+"
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}.])\d(?:[ -]?\d){12,18}(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3}[ .-]\d{4}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}])\+\d{1,3}(?:[ .-]?\d{2,4}){3,5}(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}]|\.\d)",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "name": rf"(?<!\p{{L}})(?:{'|'.join(MALE + FEMALE)})\.? {_NAME}(?: {_NAME})?",
}
PATTERN = "|".join(PATTERNS.values())
GUARD = rf"@|\d[ .-]?\d[ .-]?\d|\d\.\d|(?:{'|'.join(MALE + FEMALE)})\.? \p{{Lu}}"
KINDS = (*PATTERNS,)


def kind_of(raw: Column) -> Column:
    """The kind of a match of :data:`PATTERN`, whose alternatives are tried in this order too."""
    kind = F.lit("name")
    for name in reversed(KINDS[:-1]):
        kind = F.when(raw.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(kind)
    return kind


def _bare(raw: Column) -> Column:
    """A name without its honorific."""
    return F.regexp_replace(raw, rf"^(?:{'|'.join(MALE + FEMALE)})\.? ", "")


def gender_of(raw: Column) -> Column:
    return (F.when(raw.rlike(rf"^(?:{'|'.join(MALE)})\.? "), "m")
            .when(raw.rlike(rf"^(?:{'|'.join(FEMALE)})\.? "), "f").otherwise("x"))


def normal(kind: Column, raw: Column) -> Column:
    """What makes two spellings one entity: the digits, or lower case, names with their gender."""
    return (F.when(kind.isin("card", "phone", "ssn"), F.regexp_replace(raw, r"\D", ""))
            .when(kind == "iban", F.replace(raw, F.lit(" "), F.lit("")))
            .when(kind == "name", F.concat(gender_of(raw), F.lit(":"), F.lower(_bare(raw))))
            .when(kind == "ip", raw).otherwise(F.lower(raw)))


def _keyed(key: str, *parts: Column) -> Column:
    inner = F.sha2(F.concat_ws("\x1f", F.lit(key), *parts), 256)
    return F.sha2(F.concat(F.lit(key), F.lit("\x1e"), inner), 256)


def _number(seed: Column, place: Column | int, below: int) -> Column:
    return F.pmod(F.xxhash64(seed, place if isinstance(place, Column) else F.lit(place)), F.lit(below))


def _like(text: Column, seed: Column) -> Column:
    """Digits for digits and letters for letters, case kept; all else stays."""
    def one(c: Column, i: Column) -> Column:
        letter = lambda a: F.char(F.lit(a) + _number(seed, i, 26))
        return (F.when(c.rlike(r"\d"), _number(seed, i, 10).cast("string"))
                .when(c.rlike(r"\p{Lu}"), letter(65)).when(c.rlike(r"\p{L}"), letter(97)).otherwise(c))
    return F.array_join(F.transform(F.split(text, ""), one), "")


def luhn_sum(digits: Column) -> Column:
    """Sum of the Luhn check, of which valid numbers give multiples of ten."""
    def add(a: Column, d: Column) -> Column:
        twice = d.cast("int") * 2
        return F.struct((a["n"] + F.when(a["odd"], F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d.cast("int"))).alias("n"),
                        (~a["odd"]).alias("odd"))
    return F.aggregate(F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("n"), F.lit(False).alias("odd")), add, lambda a: a["n"])


def _card(norm: Column, seed: Column) -> Column:
    """Keeps the first digit; a number that passes the Luhn check gets one that does."""
    body = F.concat(F.substring(norm, 1, 1), _like(F.expr("substring(norm, 2, length(norm) - 2)"), seed))
    check = bound(luhn_sum(F.concat(body, F.lit("0"))), lambda s: F.pmod(10 - F.pmod(s, F.lit(10)), F.lit(10)).cast("string"))
    return F.concat(body, F.when(luhn_sum(norm) % 10 == 0, check).otherwise(_number(seed, 99, 10).cast("string")))


def _phone(norm: Column, seed: Column) -> Column:
    """Keeps all but the last ten digits, the country code; area and exchange don't begin with 0 or 1."""
    head, n = F.expr("substring(norm, 1, greatest(length(norm) - 10, 0))"), F.expr("least(length(norm), 10)")
    rest = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(
        i.isin(1, 4), _number(seed, i, 8) + 2).otherwise(_number(seed, i, 10)).cast("string"))
    return F.concat(head, F.array_join(rest, ""))


def _iban(norm: Column, seed: Column) -> Column:
    """Keeps the country; check digits are drawn like the rest."""
    return F.concat(F.substring(norm, 1, 2), _like(F.expr("substring(norm, 3)"), seed))


def _ip(norm: Column, seed: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (_number(seed, i, 254) + 1).cast("string")), ".")


def _email(norm: Column, seed: Column, key: str) -> Column:
    """The local part like the old one, at a reserved domain that depends on the old domain alone."""
    domain = F.substring_index(norm, "@", -1)
    return F.concat(_like(F.substring_index(norm, "@", 1), seed), F.lit("@"),
                    _like(F.lit("aaaaaa00"), _keyed(key, F.lit("domain"), domain)), F.lit(".example"))


def _name(norm: Column, attempt: Column, key: str) -> Column:
    """Word for word, so that a family name alone reads as it does after a first name."""
    gender, words = F.substring(norm, 1, 1), F.split(F.expr("substring(norm, 3)"), " ")

    def word(w: Column, i: Column) -> Column:
        seed = _keyed(key, F.lit("word"), w, attempt)
        style = F.when(i == F.size(words) - 1, F.lit("family")).otherwise(gender)
        made = None
        for script, (heads, tails) in SYLLABLES.items():
            head, tail = F.lit(None).cast("string"), F.lit(None).cast("string")
            starts = F.array(*(F.lit(x) for x in heads.split()))
            pick = lambda k, a=starts, n=len(heads.split()): F.element_at(a, (_number(seed, k, n) + 1).cast("int"))
            head = F.concat(*(pick(k) for k in range(4)))
            for name, ends in tails.items():
                own = ends.split()
                tail = F.when(style == name, F.element_at(F.array(*(F.lit(x) for x in own)), (_number(seed, 9, len(own)) + 1).cast("int"))).otherwise(tail)
            value = F.concat(head, tail)
            made = value if made is None else F.when(w.rlike(rf"^\p{{Is{script}}}"), value).otherwise(made)
        return made
    return F.concat(gender, F.lit(":"), F.array_join(F.transform(words, word), " "))


def surrogate(key: str) -> Column:
    """The surrogate, in normal form, of the columns ``kind``, ``norm`` and ``attempt``."""
    kind, norm, attempt = F.col("kind"), F.col("norm"), F.col("attempt").cast("string")
    seed = _keyed(key, kind, norm, attempt)
    return (F.when(kind == "email", _email(norm, seed, key)).when(kind == "card", _card(norm, seed))
            .when(kind == "phone", _phone(norm, seed)).when(kind == "iban", _iban(norm, seed))
            .when(kind == "ip", _ip(norm, seed)).when(kind == "ssn", _like(norm, seed))
            .otherwise(_name(norm, attempt, key)))


def render(kind: Column, raw: Column, made: Column) -> Column:
    """The surrogate in the format of ``raw``: its separators, spacing, honorific and case."""
    fill = F.aggregate(F.split(raw, ""), F.struct(F.lit("").alias("s"), F.lit(1).alias("k")), lambda a, c: F.when(
        c.rlike(r"[\p{L}\p{N}]"), F.struct(F.concat(a["s"], F.substring(made, a["k"], F.lit(1))).alias("s"), (a["k"] + 1).alias("k")))
        .otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["k"].alias("k"))), lambda a: a["s"])
    title = F.concat(F.expr("substring(raw, 1, length(raw) - length(bare))"),
                     F.when(F.col("bare") == F.upper("bare"), F.upper(F.substring(made, 3, 1000))).otherwise(F.initcap(F.substring(made, 3, 1000))))
    return (F.when(kind.isin("card", "phone", "ssn", "iban"), fill).when(kind == "name", title)
            .when((kind == "email") & (raw == F.upper(raw)) & (raw != F.lower(raw)), F.upper(made)).otherwise(made))


def mapping(entities: DataFrame, key: str, max_rounds: int = 40) -> DataFrame:
    """``(kind, norm, made)`` for all distinct ``(kind, norm)``: no two of a kind share ``made``, and none
    of the corpus' entities is used as one. Rounds after the first hold only what collided."""
    known = kept(entities.select("kind", "norm").distinct(), "entities")
    pending, settled = known.withColumn("attempt", F.lit(0)), None
    for _ in range(max_rounds):
        offers = kept(pending.withColumn("made", surrogate(key)), "offers")
        taken = known.select("kind", F.col("norm").alias("made"))
        if settled is not None:
            taken = taken.unionByName(settled.select("kind", "made"))
        won = kept(offers.groupBy("kind", "made").agg(F.min("norm").alias("norm"))
                   .join(taken, ["kind", "made"], "left_anti").select("kind", "norm", "made"), "settled")
        settled = won if settled is None else settled.unionByName(won)
        pending = offers.join(won, ["kind", "norm"], "left_anti").select("kind", "norm", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return settled
    raise RuntimeError(f"surrogates still collide after {max_rounds} rounds")


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id, text, entities`` of every row, personal data replaced.

    ``entities``: ``array<struct<kind, first, last, surrogate>>`` by place in the old text
    (code points, end exclusive). Null texts stay null, texts without entities pass untouched and unshuffled;
    repeated rows read alike. What a text becomes depends on the text alone, so equal texts are
    joined once, by content.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    has = F.coalesce(F.col("text").rlike(GUARD) & F.col("text").rlike(PATTERN), F.lit(False))
    hit = kept(rows.where(has).select("doc_id", "text", F.sha2("text", 256).alias("blob"),
                                      matches(F.col("text"), PATTERN).alias("hits")), "personal")
    found = (hit.select("blob", F.posexplode("hits").alias("k", "h"))
             .select("blob", "k", F.col("h.first").alias("first"), F.col("h.last").alias("last"),
                     F.col("h.found").alias("raw")).distinct())
    found = kept(found.withColumn("kind", kind_of(F.col("raw"))).withColumn("norm", normal(F.col("kind"), F.col("raw")))
                 .withColumn("bare", _bare(F.col("raw"))), "found")
    made = found.join(mapping(found, key), ["kind", "norm"]).withColumn("surrogate", render(F.col("kind"), F.col("raw"), F.col("made")))
    per = made.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("k", "kind", "first", "last", "surrogate"))).alias("e"))
    entities = F.transform("e", lambda x: F.struct(x["kind"].alias("kind"), x["first"].alias("first"),
                                                   x["last"].alias("last"), x["surrogate"].alias("surrogate")))
    text = F.array_join(F.zip_with(F.split("text", PATTERN, -1), F.transform("e", lambda x: x["surrogate"]),
                                   lambda p, s: F.concat(p, F.coalesce(s, F.lit("")))), "")
    replaced = hit.select("doc_id", "text", "blob").join(per, "blob").select("doc_id", text.alias("text"), entities.alias("entities"))
    none = F.array().cast("array<struct<kind:string,first:int,last:int,surrogate:string>>")
    return rows.where(~has).select("doc_id", "text", none.alias("entities")).unionByName(replaced)
