"""Toxicity by FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features of a whole text, each counted once: words (lower-cased, without outer
punctuation), pairs of neighbours and pairs with one word skipped, hashed into
``2 ** BITS`` coordinates. FTRL-proximal keeps a learning rate for every
coordinate and, by its L1 term, sets most weights to exactly zero; the rest is a
compact list that is broadcast (at most ``2 ** BITS + 1`` numbers).

The model is fitted on a bounded sample of the labelled rows, ``max_train`` rows
chosen by a hash of doc_id; every document is scored. Nothing but the text enters
a score.

Defined results: null and empty texts score the bias alone; without labelled rows
every score is one half; a document with several labels is toxic if one says so;
labels without a doc_id or a label are ignored; repeated rows score alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, table

BITS = 20
#: The bound of the training sample, in rows.
MAX_TRAIN = 20_000
EPOCHS = 5
#: L1 is so large that what occurs in one training text alone hardly ever gets a weight.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 15.0, 1.0
#: Toxic rows count this many times: they are the rare class.
TOXIC_WEIGHT = 8.0
PREDICT = 0.7
#: Different words whose hashes a task remembers.
CACHE = 400_000

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class Features:
    """Feature indexes of texts, with the hashes of words seen before."""

    def __init__(self, bits: int = BITS):
        self.shift, self.known = np.uint64(64 - bits), {}

    def words(self, text: str) -> np.ndarray:
        known, out = self.known, []
        if len(known) > CACHE:
            known.clear()
        for word in text.lower().split():
            value = known.get(word)
            if value is None:
                value = known[word] = xxhash.xxh64_intdigest(word.strip(string.punctuation))
            out.append(value)
        return np.array(out, np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        """Indexes, each once, in ascending order."""
        h = self.words(text or "")
        parts = [h * _ODD[0], (h[:-1] * _ODD[0] + h[1:]) * _ODD[1], (h[:-2] * _ODD[2] + h[2:]) * _ODD[3]]
        return np.unique((np.concatenate(parts) >> self.shift).astype(np.int32))


def ftrl(rows: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS, alpha: float = ALPHA,
         beta: float = BETA, l1: float = L1, l2: float = L2, toxic_weight: float = TOXIC_WEIGHT) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, weights) that are not zero; index ``2 ** bits`` is the bias, which has no penalty."""
    bias = 2 ** bits
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        penalty = np.where(at == bias, 0.0, l1)
        return np.where(np.abs(own) <= penalty, 0.0,
                        (np.sign(own) * penalty - own) / ((beta + np.sqrt(n[at])) / alpha + np.where(at == bias, 0.0, l2)))

    with_bias = [(np.append(x, np.int32(bias)), y) for x, y in rows]
    for _ in range(epochs):
        for at, label in with_bias:
            w = weights(at)
            slope = (sigmoid(w.sum()) - label) * (toxic_weight if label else 1.0)
            old = n[at]
            new = old + slope * slope
            z[at] += slope - (np.sqrt(new) - np.sqrt(old)) / alpha * w
            n[at] = new
    found = weights(np.arange(bias + 1))
    kept = np.flatnonzero(found)
    return kept, found[kept]


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, bits: int = BITS, max_train: int = MAX_TRAIN, epochs: int = EPOCHS) -> DataFrame:
    """(at, weight) of the fitted model, from rows of ``labels`` that are not held out."""
    sample = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .withColumn("turn", F.xxhash64("doc_id", F.lit("ftrl"))).orderBy("turn", "doc_id").limit(max_train))
    sample = materialize(sample, "sample")  # at most max_train rows, hence the broadcast

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Features(bits)
        for batch in batches:
            found = [find(t).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())],
                                             names=["turn", "toxic", "found"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(x, np.int32), y) for batch in batches
                for y, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        at, weight = ftrl(rows, bits, epochs) if rows else (np.zeros(0, np.int64), np.zeros(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(weight)], names=["at", "weight"])

    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("turn", "toxic", "text") \
        .mapInArrow(features, "turn long, toxic int, found binary")
    one = found.repartition(1).sortWithinPartitions("turn", "found")  # bounded by max_train documents
    return materialize(one.mapInArrow(learn, "at long, weight double"), "weights")


def score(docs: DataFrame, model: DataFrame, bits: int = BITS) -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""
    weights = model.orderBy("at").toArrow()  # at most 2 ** bits + 1 rows
    sparse = docs.sparkSession.sparkContext.broadcast(
        (weights["at"].to_numpy(), weights["weight"].to_numpy().astype(np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, weight = sparse.value
        dense = np.zeros(2 ** bits + 1)
        dense[at] = weight
        find = Features(bits)
        for batch in batches:
            scores = [sigmoid(dense[find(t)].sum() + dense[-1]) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, bits: int = BITS, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    return score(docs, train(docs, labels, bits, max_train), bits).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: toxicity of all documents."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
