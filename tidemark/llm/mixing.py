"""Mixing sources to target weights by blocks.

1. Each source's words are packed, document after document in a pseudorandom
   order, into blocks of ``block`` words; only the last block of a source is short.
2. Targets: all sources share ``factor`` times the corpus by weight; a target
   stops at ``cap`` times its source, and the excess goes to the others by weight
   until none is above (water-filling, in closed form over the sorted ratios).
3. A source's target is whole passes over it and a rest, hence a number of block
   slots. Their counts per output shard are a multinomial draw (seeded by source).
4. Slot k takes the block ``perm(k mod blocks)``, a keyed pseudorandom permutation
   of the source's block indexes (Feistel network with cycle walking; the short
   block is the last of each pass), and slots meet blocks in a join by index. The
   last slot is cut at the word, so a source's mix hits its target within a word,
   and each pass takes a block at most once: no document exceeds ``ceil(cap)`` passes.

Prefix sums run within (source, hash bucket) and over the bucket sums, so a
source that holds a third of all rows is spread over ``BUCKETS`` groups.

Defined results: null, empty and blank texts have size zero and are never taken;
a null source is a source (the last in order); equal rows are packed as rows of
their own; an empty table gives an empty result; a corpus without words has
targets of zero; other columns are ignored by ``mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import IS_SPACE, attach, materialize, row_key, table, unused

WEIGHTS = (5, 2, 1)
FACTOR = 1.5
CAP = 2.0
BLOCK = 256
#: Slots of one output shard, on average.
SHARD_SLOTS = 4096
BUCKETS = 4096
SEED = 20240613
#: Round constants of the Feistel network: multiples of the 64-bit golden ratio.
TURNS = [np.uint64(k * 0x9E3779B97F4A7C15 % 2**64) for k in range(1, 7)]


def count_words(texts: pa.Array) -> pa.Array:
    """Words of each UTF-8 text of a batch, over its buffer at once; null: 0."""
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    if n == 0 or ends[-1] == ends[0]:
        return pa.array(np.zeros(n, np.int64))
    inside = ~IS_SPACE[np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]]]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    at = (ends[:-1] - ends[0]).copy()
    full = ends[1:] > ends[:-1]
    starts[at[full]] = inside[at[full]]
    out = np.zeros(n, np.int64)
    out[full] = np.add.reduceat(starts, at[full], dtype=np.int64)
    return pa.array(out)


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, source, size)."""
    words = F.arrow_udf(count_words, "long")
    return docs.select("doc_id", row_key().alias("row_key"), "source", words(F.col("text").cast("binary")).alias("size"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, factor: float = FACTOR, cap: float = CAP) -> DataFrame:
    """(source, number, total, target) from (source, size). One row per source; windows run over these rows only."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("total"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    weighed = per.select("source", "total", F.row_number().over(order).alias("number")).withColumn(
        "weight", F.get(F.array(*map(F.lit, map(float, weights))), (F.col("number") - 1) % len(weights)))
    # ascending by how soon the cap is met: those before a row are capped if the row is not
    rising = W.orderBy(cap * F.col("total") / F.col("weight"), "number")
    before, after = rising.rowsBetween(W.unboundedPreceding, -1), rising.rowsBetween(0, W.unboundedFollowing)
    level = weighed.withColumn(
        "level", (factor * F.sum("total").over(W.partitionBy()) - F.coalesce(cap * F.sum("total").over(before), F.lit(0.0)))
        / F.sum("weight").over(after)).withColumn("open", F.col("level") * F.col("weight") <= cap * F.col("total"))
    # the first row that its level leaves below its cap sets the level of all later ones
    open_level = F.min(F.when(F.col("open"), F.struct((cap * F.col("total") / F.col("weight")).alias("r"), "number", "level"))) \
        .over(W.partitionBy())
    return level.withColumn("first", open_level).select(
        "source", "number", "total",
        F.when(F.col("first").isNull(), cap * F.col("total"))
        .otherwise(F.least(cap * F.col("total"), F.col("first.level") * F.col("weight"))).alias("target"))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0 .. size - 1 at ``index``, for rows that may differ in size and key."""
    half = np.maximum(1, np.ceil(np.log2(np.maximum(size, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)

    def mixed(x: np.ndarray) -> np.ndarray:  # an integer finaliser (xor-shift-multiply)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    out = index.astype(np.uint64)
    size, key = size.astype(np.uint64), key.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):  # walk the cycle until the value is below size
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for turn in TURNS:
            left, right = right, left ^ (mixed(right + key[todo] + turn) & mask[todo])
        out[todo] = (left << half[todo]) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def slots(sources: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(number, shard, pass, block, words): what each output slot takes, from ``targets``."""
    words = F.round("target").cast("long")
    plan = sources.filter("total > 0").withColumn("words", words).select(
        "number", F.ceil(F.col("total") / block).cast("long").alias("blocks"),
        F.expr("words div total").alias("passes"), (F.col("words") % F.col("total")).alias("rest"))
    plan = plan.withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block).cast("long"))
    shards = F.greatest(F.lit(1), F.ceil(F.sum("slots").over(W.partitionBy()) / shard_slots)).cast("long")
    plan = plan.withColumn("shards", shards).filter("slots > 0")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["shards"]
                counts = np.random.default_rng([seed, row["number"]]).multinomial(row["slots"], np.full(n, 1 / n))
                first = np.cumsum(counts) - counts
                for k in range(0, n, 100_000):  # batches of bounded size
                    part = slice(k, k + 100_000)
                    m = len(counts[part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(m, row[c])) for c in ("number", "blocks", "rest")]
                        + [pa.array(np.arange(k, k + m)), pa.array(first[part]), pa.array(counts[part])],
                        names=["number", "blocks", "rest", "shard", "first", "n"])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, blocks, rest, shard, slot = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            lap, k = slot // blocks, slot % blocks
            inner = np.where(k < blocks - 1, permuted(np.minimum(k, np.maximum(blocks - 2, 0)), np.maximum(blocks - 1, 1),
                                                      number * np.int64(1_000_003) + seed), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (number, shard, lap, inner, np.minimum(block, rest - k * block))],
                names=["number", "shard", "pass", "block", "cut"])

    drawn = plan.select("number", "blocks", "rest", "slots", "shards").mapInArrow(
        draw, "number long, blocks long, rest long, shard long, first long, n long").filter("n > 0")
    each = drawn.select("number", "blocks", "rest", "shard", F.explode(F.expr("sequence(first, first + n - 1)")).alias("slot"))
    taken = each.mapInArrow(take, "number long, shard long, pass long, block long, cut long")
    return taken.join(plan.select("number", "passes"), "number").select(
        "number", "shard", "pass", "block",
        F.when(F.col("pass") < F.col("passes"), block).otherwise(F.col("cut")).cast("long").alias("words"))


def packed(found: DataFrame, block: int = BLOCK) -> DataFrame:
    """``found`` (row_key, number, size) with the offset of each row in its source's packed words."""
    bucket = F.pmod("row_key", F.lit(BUCKETS))
    rows = found.withColumn("bucket", bucket)
    sums = rows.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    starts = sums.select("number", "bucket", (F.sum("words").over(W.partitionBy("number").orderBy("bucket"))
                                               - F.col("words")).alias("start"))
    within = W.partitionBy("number", "bucket").orderBy("row_key", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn("upto", F.sum("size").over(within)).join(starts, ["number", "bucket"]).withColumn(
        "offset", F.col("start") + F.col("upto") - F.col("size")).drop("bucket", "upto", "start")


def pieces(found: DataFrame, block: int = BLOCK) -> DataFrame:
    """The blocks of each packed row: (number, offset, block, word, at, words); ``at`` counts within the block."""
    spread = found.filter("size > 0").select(
        "number", "offset", "size", F.explode(F.expr(f"sequence(offset div {block}, (offset + size - 1) div {block})")).alias("block"))
    start = F.greatest(F.col("offset"), F.col("block") * block)
    end = F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * block)
    return spread.select("number", "offset", "block", (start - F.col("offset")).alias("word"),
                         (start - F.col("block") * block).alias("at"), (end - start).alias("words"))


def plan_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, factor: float = FACTOR, cap: float = CAP,
             block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(rows, takes): packed rows with their source's total and target, and what the mix takes of them.

    ``takes``: (number, offset, shard, pass, word, words); number and offset identify a row of ``rows``
    that has words, and ``word`` is the first word taken.
    """
    found = materialize(sized(docs), "sizes")
    sources = materialize(targets(found, weights, factor, cap), "sources")
    rows = found.join(sources, found["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    rows = materialize(packed(rows, block), "packed")
    chosen = slots(sources, block, shard_slots, seed).withColumnRenamed("words", "limit")
    met = pieces(rows, block).join(chosen, ["number", "block"])
    takes = met.select("number", "offset", "shard", "pass", "word",
                       F.least("words", F.col("limit") - F.col("at")).alias("words")).filter("words > 0")
    return rows, takes


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``."""
    rows, takes = plan_mix(docs, **options)
    taken = takes.groupBy("number", "offset").agg(F.sum("words").alias("taken"))
    some, none = rows.filter("size > 0"), rows.filter("size <= 0")
    out = ["doc_id", "size", F.col("total").alias("source_size"), "target"]
    return some.join(taken, ["number", "offset"], "left").select(
        *out, F.coalesce("taken", F.lit(0).cast("long")).alias("taken")).unionByName(
        none.select(*out, F.lit(0).cast("long").alias("taken")))


def cut_text(text: str, ranges: list[tuple[int, int]]) -> str:
    """The given ranges (first word, number of words; ascending) of a text, with the white space inside them."""
    body = text.encode()
    inside = ~IS_SPACE[np.frombuffer(body, np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    joined: list[list[int]] = []
    for first, n in ranges:
        if joined and joined[-1][1] == first:
            joined[-1][1] = first + n
        else:
            joined.append([first, first + n])
    if joined == [[0, len(starts)]]:
        return text
    return b"\n".join(body[starts[a]:ends[b - 1]] for a, b in joined).decode()


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """The mix as documents: for each row and pass, the words taken, with the columns of ``docs``.

    A text that a pass takes whole stays as it is; ``n_chars``, where there is one, follows the text.
    """
    rows, takes = plan_mix(docs, **options)
    spans_name = unused(docs.columns, "__ranges")
    ranges = takes.groupBy("number", "offset", "pass").agg(
        F.array_sort(F.collect_list(F.struct("word", "words"))).alias(spans_name))
    keyed_rows = rows.filter("size > 0").select("number", "offset", F.col("row_key").alias("__row_key"))
    repeated = materialize(rows.groupBy(F.col("row_key").alias("__row_key")).count().filter("count > 1").select("__row_key"),
                           "repeated")
    cuts = keyed_rows.join(ranges, ["number", "offset"]).select("__row_key", spans_name)

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([cut_text(t, [(r["word"], r["words"]) for r in s])
                         for t, s in zip(texts.to_pylist(), spans.to_pylist())], pa.string())

    out = attach(docs, cuts, repeated).withColumn("text", cut("text", spans_name))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: the share of all documents in the mix."""
    return mix(table(spark, sf_dir, "documents"))

