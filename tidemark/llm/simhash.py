"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: 64 majority bits of the hashes of all 4-word shingles of the
whole text. Two fingerprints link if they differ in at most ``radius`` bits.

Covering masks: every bit i gets a non-zero vector phi(i) of ``radius + 1`` bits;
table v (each non-zero v) keeps the bits with odd <phi(i), v>. The at most
``radius`` vectors of the bits in which a pair differs leave some v orthogonal to
them all, and in that table the pair's masked fingerprints are equal. So every
pair within the radius meets in some table: no false negatives.

Only connectivity is asked for, so a bucket gives a spanning forest of its
verified links (fewer edges than members) and never all its pairs. A bucket of
more than ``BUCKET`` different fingerprints is hashed again, within itself, by
the next family of covering masks, which again covers all its pairs; this repeats
until every bucket is small, whatever the size of the group.

Defined results: null, empty and blank texts have fingerprint zero and link like
any other; repeated rows and equal texts share a fingerprint; null doc_ids are
ignored for component_id, which is null only if a component has no other; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, row_key, signed64, table, unused
from tidemark.llm.graph import components

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
#: Different fingerprints that one task compares with one another.
BUCKET = 2048


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate([[0], ends[:-1] + 1])
    count = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[i:j], seed) for i, j in zip(first[:count].tolist(), ends[-count:].tolist())), np.uint64, count)
    ones = np.unpackbits(hashes.view(np.uint8).reshape(count, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row_key, fp): fp holds the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signed64(found))],
                                             names=["doc_id", "row_key", "fp"])

    return docs.select(F.col("doc_id").cast("long"), row_key().alias("row_key"), F.col("text").cast("binary")) \
        .mapInArrow(run, "doc_id long, row_key long, fp long")


def covering_masks(radius: int, family: int = 0, bits: int = BITS) -> list[int]:
    """The masks of one covering family; families differ in which bit gets which vector."""
    vectors = 2 ** (radius + 1) - 1
    order = np.random.default_rng(family).permutation(bits)
    phi = [int(order[i]) % vectors + 1 for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (phi[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def forest(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning edges of the links within ``radius`` among different fingerprints (uint64)."""
    left = members
    edges: list[tuple[int, int]] = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= radius
            if near.any():
                reached, left = left[near], left[~near]
                edges += [(at, x) for x in reached]
                queue += list(reached)
    return edges


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between different values of ``fps.fp`` that connect what links within ``radius`` connect."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [e for m in batch.column(0) for e in forest(m.values.to_numpy().view(np.uint64), radius)]
            pairs = np.array(found, np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(signed64(pairs[:, k].copy())) for k in (0, 1)], names=["a", "b"])

    found, family = [], 0
    rows = fps.select(F.lit(0).cast("long").alias("group"), "fp").distinct()
    while True:
        masks = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(int(signed64(np.array([m], np.uint64))[0])).alias("mask"))
                          for v, m in enumerate(covering_masks(radius, family))])
        hashed = rows.select("group", "fp", F.explode(masks).alias("t")).select(
            F.xxhash64("group", F.col("t.v"), F.col("fp").bitwiseAND(F.col("t.mask"))).alias("group"), "fp")
        shared = materialize(hashed.groupBy("group").agg(
            F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1"), "buckets")
        found.append(shared.filter((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
                     .select("a", "b").distinct())
        more = hashed.join(shared.filter("n > 2").select("group", "n"), "group")
        found.append(more.filter(F.col("n") <= bucket).groupBy("group")
                     .agg(F.array_sort(F.collect_list("fp")).alias("fps")).select("fps").distinct()
                     .mapInArrow(run, "a long, b long").distinct())
        if shared.filter(F.col("n") > bucket).isEmpty():
            break
        rows = materialize(more.filter(F.col("n") > bucket).select("group", "fp"), "hot-buckets")
        family += 1
    out = found[0]
    for df in found[1:]:
        out = out.union(df)
    return out


def classes(found: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(fp, label, component_id) of every different fingerprint of ``found`` (doc_id, row_key, fp)."""
    own = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    label = components(links(own, radius, bucket)).withColumnRenamed("node", "fp")
    labelled = own.join(label, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"), "first_id")
    first = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return materialize(labelled.join(first, "label").select("fp", "label", "component_id"), "components")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, row_key, fp, label, component_id) for every row of ``docs``."""
    found = materialize(fingerprints(docs, shingle), "fingerprints")
    return found.join(classes(found, radius, bucket), "fp")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id (nulls last; ties: smallest text key).

    Of identical repeated rows one stays.
    """
    grouped = near_duplicates(docs, shingle, radius, bucket)
    own = unused(docs.columns, "__row_key")
    firsts = materialize(
        grouped.groupBy("label", "row_key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
        .groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", "n")).alias("x"))
        .select(F.col("x.row_key").alias(own), F.col("x.n").alias("n")), "firsts")
    with_key = docs.withColumn(own, row_key())
    once = with_key.join(firsts.filter("n = 1").select(own), own, "left_semi")
    if not firsts.filter("n > 1").isEmpty():
        once = once.unionByName(with_key.join(firsts.filter("n > 1").select(own), own, "left_semi").dropDuplicates([own]))
    return once.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: fingerprint and component of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
