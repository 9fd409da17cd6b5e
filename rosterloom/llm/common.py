"""Reading tables, keeping intermediate tables, and connected components."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives Python workers this package, once per application, through Spark's own file service."""
    if spark.sparkContext.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    path = os.path.join(tempfile.mkdtemp(), "rosterloom.zip")
    with open(path, "wb") as file:
        file.write(data.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(spark.sparkContext.applicationId)


def in_arrow(frame: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` by workers that have this package."""
    ship(frame.sparkSession)
    return frame.mapInArrow(run, schema)


def texts(docs: DataFrame, id_type: str = "long") -> DataFrame:
    """``doc_id`` and ``text`` alone, typed."""
    return docs.select(F.col("doc_id").cast(id_type).alias("doc_id"), F.col("text").cast("string").alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder of the (shared) warehouse."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_llm").rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def kept(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    Cuts lineage and survives lost executors; what made the frame runs once. Texts and ids
    are most of it, which zstd packs tighter than the default.
    """
    path = new_folder(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once.

    Catalyst inlines projections into lambda bodies, where an expression would run
    for each element; a lambda variable holds the value instead.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def _checksum(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (any orderable ids): rows ``(node, root)``.

    Alternates the large-star and small-star steps: each links all neighbours of a
    node to their minimum, so no pairs within a group are made, and long chains
    shrink by a constant factor per round. The root is the least node. Nodes
    without an edge to another node, and null ids, are not returned. Each round
    is a written table; minima are pre-aggregated before the shuffle, and the joins back on a
    node may be split by AQE.
    """
    edges = (edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges, before = kept(edges, "edges"), None
    for _ in range(max_rounds):
        state = _checksum(edges)
        if state == before or state[0] == 0:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # Larger ends now point to smaller ones; small-star joins what a node points to.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
        edges = kept(small, "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.groupBy("a").agg(F.min("b").alias("root"))
    return (roots.select(F.col("a").alias("node"), "root")
            .unionByName(roots.select(F.col("root").alias("node"), "root").distinct()))


def free_name(frame: DataFrame, base: str) -> str:
    """A column name that ``frame`` does not have yet (names differ by more than case)."""
    taken = {c.lower() for c in frame.columns}
    while base.lower() in taken:
        base += "_"
    return base


def row_key() -> Column:
    """Tells the rows of documents apart by ``doc_id`` and ``text``; repeated rows are equal.

    The text's hash only has to tell apart the texts of one id.
    """
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                       F.hex(F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))))
