"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its distinct words, word pairs and pairs with one word between, hashed to 2**BITS. The model is
fitted in one task on at most ``TRAIN_DOCS`` labelled documents (the smallest hashes of doc_id), in ``EPOCHS`` passes
in a hashed order; what L1 leaves of the weights is broadcast (at most 2**BITS floats, whatever the corpus), and all
documents are scored where they are read, without a shuffle.

Defined results: null or empty text has the bias alone; without labels of both classes every score is 0.5 by an
untrained model; repeated rows score alike; labels, lang, source and doc_id never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, distinct, documents
from .ftrl import Ftrl, expand, sigmoid

BITS, TRAIN_DOCS, EPOCHS = 20, 14_000, 3
FIT = {"alpha": 2.0, "beta": 1.0, "l1": 3.0, "l2": 0.1}
THRESHOLD = 0.7
_EDGE = b".,;:!?\"'()[]{}*%$#&|<>-_"


class _Words(dict):
    """word bytes -> hash of the word without marks at its ends."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.strip(_EDGE))
        return h


_WORDS = _Words()


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Distinct feature indices; 0 is the bias."""
    w = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    h = np.fromiter(map(_WORDS.__getitem__, w), np.uint64, len(w))
    parts = [h]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        if len(h) > gap:
            parts.append((h[:-gap] * np.uint64(salt)) ^ (h[gap:] >> np.uint64(3)))
    x = np.concatenate(parts) * np.uint64(0xD6E8FEB86659FD93)
    x = (x >> np.uint64(64 - bits)).astype(np.int32)
    seen = np.zeros(1 << bits, bool) if len(x) > 20_000 else None
    if seen is not None:
        seen[x] = True
        x = np.flatnonzero(seen).astype(np.int32)
    else:
        x = distinct(x)
    return np.concatenate([[0], x[x > 0]]).astype(np.int32)


def _sample(docs: DataFrame, labels: DataFrame, label: str, where, limit: int) -> DataFrame:
    """At most ``limit`` labelled documents with the smallest hashes of doc_id: (key, label, text). The id list is bounded, so
    it is broadcast."""
    ids = labels.filter(where & F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
    ids = ids.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id").select(F.xxhash64("doc_id").alias("key"), "label", "text")


def fit(sample: DataFrame, bits: int = BITS, epochs: int = EPOCHS, **rates: float) -> tuple[np.ndarray, np.ndarray]:
    """Train on a bounded sample (key, label, text): features are taken in parallel, the updates run in one task, and only
    non-zero weights come to the driver."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t, bits).tobytes() for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x, pa.binary())], names=["key", "label", "x"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        rows.sort(key=lambda r: (r[0], r[2], r[1]))
        model = Ftrl(bits, **(FIT | rates))
        if len({y for _, y, _ in rows}) > 1:
            ones = np.ones(1 << 12)
            for _ in range(epochs):
                for _, y, x in rows:
                    idx = np.frombuffer(x, np.int32)
                    if len(idx) > len(ones):
                        ones = np.ones(2 * len(idx))
                    model.learn(idx, ones[: len(idx)], y)
        at, w = model.compact()
        yield pa.RecordBatch.from_arrays([pa.array([at.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary())], names=["at", "w"])

    got = sample.mapInArrow(extract, "key long, label double, x binary").repartition(1).mapInArrow(train, "at binary, w binary").collect()
    return np.concatenate([np.frombuffer(r.at, np.int32) for r in got]), np.concatenate([np.frombuffer(r.w, np.float32) for r in got])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], bits: int = BITS) -> DataFrame:
    """doc_id, score for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = expand(*sent.value, bits)
        for b in batches:
            x = [float(sigmoid(dense[features(t, bits)].sum(dtype=np.float64))) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.float64())], names=["doc_id", "score"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    held = crc_mod("doc_id", 3) == 1
    model = fit(_sample(docs, labels, "toxic", ~held, train_docs))
    out = score(docs, model).withColumn("held_out", F.coalesce(held, F.lit(False)))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op3_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op3_toxicity_ftrl": op3_toxicity_ftrl}
ORACLE: dict[str, str] = {}
