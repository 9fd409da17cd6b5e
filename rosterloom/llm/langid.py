"""Language identification by string kernels.

A text is the set of its n-grams of 1 to ``longest`` bytes (lower-cased UTF-8), hashed to a
fixed number of buckets: the presence features of a blended-spectrum kernel. The kernel of two texts is
the number of shared features over the geometric mean of their numbers. Landmark texts
give a Nyström map, on which one-versus-rest kernel ridge regression is solved. Scoring is
two matrix products per batch of texts: kernels with the landmarks, then weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterloom.llm.common import in_arrow, texts
from rosterloom.operators import top_k_per_group

UNKNOWN = "und"
_BYTES = "doc_id long, features binary"


@dataclass(frozen=True)
class Kernel:
    """``per_language`` bounds the training sample: that many labelled rows of each language, by hash order."""

    longest: int = 3
    buckets: int = 8192
    per_language: int = 300
    landmarks: int = 48
    ridge: float = 1e-3
    batch: int = 256


@dataclass(frozen=True)
class Model:
    kernel: Kernel
    languages: list[str]
    landmarks: np.ndarray  # landmarks x buckets, scaled to unit length
    weights: np.ndarray  # landmarks x languages: Nyström map and ridge weights in one
    bias: np.ndarray


def _tables(kernel: Kernel) -> list[np.ndarray]:
    """Bucket of every n-gram of up to two bytes; longer ones are mixed from these by a multiplier."""
    rng = np.random.default_rng(7)
    return [rng.integers(0, 1 << 32, 256 if n == 1 else 65536, dtype=np.uint64) for n in (1, 2)]


def presence(texts: list[str], kernel: Kernel, tables=None) -> np.ndarray:
    """One row of 0 and 1 per text; whole texts, of any length."""
    one, two = tables or _tables(kernel)
    out = np.zeros((len(texts), kernel.buckets), np.float32)
    mask = np.uint64(kernel.buckets - 1)
    for row, text in zip(out, texts):
        raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
        for at in range(0, max(len(raw), 1), 1 << 16):  # parts overlap so that no n-gram is lost
            part = raw[at:at + (1 << 16) + kernel.longest - 1]
            row[one[part] & mask] = 1
            if len(part) < 2:
                continue
            pair = (part[:-1].astype(np.uint32) << 8) | part[1:]
            mixed = two[pair]
            row[mixed & mask] = 1
            for n in range(3, kernel.longest + 1):
                mixed = mixed[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[part[n - 1:]]
                row[(mixed >> np.uint64(29)) & mask] = 1
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


_ROW = ["doc_id", "text_hash", "lang"]


def _labelled(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.where("lang IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", F.xxhash64(text).alias("text_hash"), F.col("lang").cast("string").alias("lang"), text.alias("text"))


def training_sample(docs: DataFrame, kernel: Kernel) -> DataFrame:
    """``(doc_id, text_hash, lang)`` of at most ``per_language`` rows of each language; repeated rows count as one.

    Every task keeps that many rows of a language at most, then every group of tasks, then
    one task per language: none gets more than a fixed number for each group, and one language may hold all rows.
    One id may hold many texts and languages, and may be null.
    """
    order = [F.xxhash64(*_ROW), *_ROW]
    rows = _labelled(docs).select(*_ROW).distinct().withColumn("tasks", F.pmod(F.spark_partition_id(), F.lit(128)))
    few = top_k_per_group(rows, ["lang", "tasks"], order, kernel.per_language)
    return top_k_per_group(few.drop("tasks"), ["lang"], order, kernel.per_language)


def fit(docs: DataFrame, kernel: Kernel = Kernel()) -> Model | None:
    """Learns from ``text`` and ``lang`` of the sample; None without a labelled text that has a letter.

    Features of the sampled texts are made where these lie; a kilobyte for each
    comes to the driver, ``per_language`` for each language at most.
    """
    ids = [tuple(r[c] for c in _ROW) for r in training_sample(docs, kernel).collect()]
    if not ids:
        return None
    spark = docs.sparkSession
    chosen = F.broadcast(spark.createDataFrame(ids, "own_id long, own_hash long, own_lang string"))
    rows = _labelled(docs)
    found = rows.join(chosen, rows["doc_id"].eqNullSafe(chosen["own_id"]) & (rows["text_hash"] == chosen["own_hash"])
                      & (rows["lang"] == chosen["own_lang"]))
    # Copies of a row become one in each task already.
    sample = found.groupBy(*_ROW).agg(F.first("text").alias("text"))

    def featurize(batches):
        tables = _tables(kernel)
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = [k for k, t in enumerate(texts) if has_letter(t)]
            for at in range(0, len(keep), kernel.batch):
                own = keep[at:at + kernel.batch]
                bits = np.packbits(presence([texts[k] for k in own], kernel, tables).astype(bool), axis=1)
                yield pa.RecordBatch.from_pydict({"lang": [langs[k] for k in own], "features": [b.tobytes() for b in bits]})

    got = in_arrow(sample.select("text", "lang"), featurize, "lang string, features binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["lang"], bytes(r["features"])))
    x = _unit(np.unpackbits(np.array([np.frombuffer(r["features"], np.uint8) for r in got]), axis=1).astype(np.float32))
    y = np.array([r["lang"] for r in got])
    languages = sorted(set(y))
    rng = np.random.default_rng(11)
    marks = np.concatenate([rng.permutation(np.flatnonzero(y == c))[:kernel.landmarks] for c in languages])
    z = x[marks]
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    good = values > 1e-6 * values[-1]
    nystroem = vectors[:, good] / np.sqrt(values[good])
    phi = (x @ z.T) @ nystroem
    target = np.where(y[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    share = np.sqrt(1 / np.maximum((y[:, None] == np.array(languages)[None, :]).sum(axis=0), 1))[np.searchsorted(languages, y)]
    mean = np.average(phi, axis=0, weights=share ** 2)
    middle = np.average(target, axis=0, weights=share ** 2)
    a, b = (phi - mean) * share[:, None], (target - middle) * share[:, None]
    w = np.linalg.solve(a.T @ a + kernel.ridge * len(languages) * np.eye(phi.shape[1]), a.T @ b)
    return Model(kernel, languages, z.astype(np.float32), (nystroem @ w).astype(np.float32), (middle - mean @ w).astype(np.float32))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from its whole text alone.

    ``score`` is the share of the best language among margins mapped to positive numbers, from 0 to 1.
    A null text, one without a letter, and any text without a model, is ``und`` with score 0. Ties take the
    alphabetically first language. The model's size is fixed by :class:`Kernel` and the number of languages.
    """
    def run(batches):
        tables = _tables(model.kernel) if model else None
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                texts = part.column(1).to_pylist()
                known = [k for k, t in enumerate(texts) if model and has_letter(t)]
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if known:
                    rows = _unit(presence([texts[k] for k in known], model.kernel, tables))
                    margin = np.exp(4.0 * (rows @ model.landmarks.T @ model.weights + model.bias).astype(np.float64))
                    best = margin.argmax(axis=1)
                    for k, b, s in zip(known, best, margin.max(axis=1) / margin.sum(axis=1)):
                        names[k], scores[k] = model.languages[b], float(s)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "lang_pred": names, "score": scores})

    size = model.kernel.batch if model else 1024
    return in_arrow(texts(docs), run, "doc_id long, lang_pred string, score double")
