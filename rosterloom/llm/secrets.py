"""Secret scans over an incremental blob ledger.

Every version of a file is a row of (path, text). A version's content address is the
SHA-256 of its text; the ledger remembers the findings of each pair of blob and rule version, so
a scan reads only pairs that it has not seen, whatever number of paths or versions share
a blob. Findings are joined back to all paths. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterloom.llm.common import new_folder
from rosterloom.llm.spans import matches

_FINDING = "array<struct<first:int,last:int,kind:string>>"
_BLOBS = f"blob string, rule string, version int, findings {_FINDING}"


@dataclass(frozen=True)
class Rule:
    """A match counts if ``group`` of it (by number) has ``least`` or more characters.

    ``guard`` is a cheap pattern that every match contains. A changed rule needs a new version.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    guard: str | None = None
    version: int = 1

    def findings(self, text: Column) -> Column:
        hits = matches(text, self.pattern, text.rlike(self.guard) if self.guard else None)
        if self.least:
            hits = F.filter(hits, lambda x: F.char_length(
                F.regexp_extract(x["found"], self.pattern, self.group)) >= self.least)
        return F.transform(hits, lambda x: F.struct(
            x["first"].alias("first"), x["last"].alias("last"), F.lit(self.kind).alias("kind")))


# The base rules. Runs of hex digits are taken whole, so the bound may be part of the pattern;
# an assignment that is too short still uses up its characters, so there it may not.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         least=8, group=2, guard="[:=]"),
    Rule("access", r"AKIA[A-Z0-9]{12,}", guard="AKIA"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
# Further rules of our own.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", guard="PRIVATE KEY"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", guard="eyJ"),
)


@dataclass
class BlobLedger:
    """Findings by blob and rule version, in Parquet files below ``path``; scans append to it.

    ``path`` must be one that all executors share. A scan that fails leaves no finding half
    written: a pair counts as seen once Spark has committed its file, and is deduplicated when read.
    """

    spark: SparkSession
    path: str
    rules: tuple[Rule, ...] = field(default=BASE_RULES + MORE_RULES)

    def known(self) -> DataFrame:
        """Findings of this ledger's rule versions."""
        try:
            seen = self.spark.read.schema(_BLOBS).parquet(self.path)
        except Exception as error:  # no scan has been committed yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            seen = self.spark.createDataFrame([], _BLOBS)
        wanted = [(F.col("rule") == r.kind) & (F.col("version") == r.version) for r in self.rules]
        keep = F.lit(False)
        for w in wanted:
            keep = keep | w
        return seen.where(keep)

    def scan(self, versions: DataFrame, text: str = "text") -> DataFrame:
        """Scans what is unseen among ``versions`` and returns them with a ``blob`` column.

        Copies of a blob are reduced to one before the shuffle; the seen pairs are a small set per blob. A
        null text is empty.
        """
        addressed = versions.withColumn("blob", content_address(F.col(f"`{text}`")))
        blobs = addressed.groupBy("blob").agg(F.first(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("text"))
        seen = self.known().groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        due = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
        per_rule = [
            F.when(~F.array_contains("seen", r.kind), F.struct(
                F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"),
                r.findings(F.col("text")).alias("findings"))) for r in self.rules]
        fresh = (due.select("blob", F.explode(F.filter(F.array(*per_rule), lambda x: x.isNotNull())).alias("r"))
                 .select("blob", "r.rule", "r.version", "r.findings"))
        fresh.write.mode("append").parquet(self.path)
        return addressed

    def findings(self, addressed: DataFrame) -> DataFrame:
        """``addressed`` rows with all findings of their blob, by start and then by the rules' order.

        Only blobs that have findings are joined: most rows meet nothing, and a blob that many paths share is
        one row on the small side.
        """
        order = {r.kind: k for k, r in enumerate(self.rules)}
        rank = F.create_map(*(F.lit(x) for item in order.items() for x in item))
        found = (self.known().where(F.size("findings") > 0)
                 .groupBy("blob").agg(F.flatten(F.array_distinct(F.collect_list("findings"))).alias("all"))
                 .select("blob", F.transform(F.sort_array(F.transform("all", lambda x: F.struct(
                     x["first"].alias("first"), rank[x["kind"]].alias("rank"), x["last"].alias("last"),
                     x["kind"].alias("kind")))), lambda x: F.struct(
                         x["kind"].alias("kind"), x["first"].alias("first"), x["last"].alias("last"))).alias("findings")))
        return (addressed.join(found, "blob", "left")
                .withColumn("findings", F.coalesce(
                    "findings", F.array().cast("array<struct<kind:string,first:int,last:int>>"))))


def content_address(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def scan_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, blob, findings`` of every row, through a ledger at ``path`` (default: a new one).

    Null and empty texts share one blob without findings. Repeated rows are repeated. Other columns are not read.
    """
    spark = docs.sparkSession
    ledger = BlobLedger(spark, path or new_folder(spark, "ledger"))
    addressed = ledger.scan(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    return ledger.findings(addressed.select("doc_id", "blob"))
