"""Benchmark decontamination by spaced-seed hashing.

A fixed mask reads some positions of a token window and ignores the others, so a
window still matches if a substitution falls on an ignored position; several
masks ignore different ones. Hashes of all windows of the benchmark are joined
with those of all documents; around every hit the tokens of both texts are
compared position by position, and an overlap is a stretch of at least
``min_tokens`` aligned tokens (the whole item, if that is shorter) of which
``min_equal`` are equal.

Only document windows that hit a bitmap of the benchmark's hashes leave their
task. The bitmap has a fixed size (``2 ** BITMAP_BITS`` bits), whatever the size
of the benchmark: a larger benchmark lets more windows pass, and the join, which
is exact, drops them.

Defined results: tokens are maximal runs of letters, digits and underscores,
lower-cased; null and empty texts match nothing; items of fewer than ``SHORT``
tokens match nothing; overlaps of ``SHORT`` to ``COVERED - 1`` tokens are found by
masks of their own. Every way in which an overlap may differ from its item leaves at
least one window of one mask whole, as long as ``min_equal`` is 0.8 or more (checked
exhaustively in the tests). Repeated rows are found alike; an empty documents or benchmark
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import drop_rows, materialize, row_key, signed64, table

#: 1 reads a token, 0 ignores it: six each. They hit every overlap of ``COVERED`` tokens and more.
MASKS = ("1101111", "1101010011", "1111001001", "111111")
COVERED = 13
#: The masks of overlaps that may be shorter than that; ``FIVE`` are needed beside them for items of ``SHORT`` tokens.
SHORT_MASKS, FIVE = ("1111", "11011"), ("10111", "11101")
SHORT = 5
MIN_TOKENS = 13
MIN_EQUAL = 0.8
#: Tokens on each side of a hit that leave the task with it.
AROUND = 64
BITMAP_BITS = 26
#: Bits of one row of Spark's bitmap aggregate.
ROW_BITS = 32768
CACHE = 400_000

_TOKEN = re.compile(r"\w+")


class Tokens:
    """Hashes of the tokens of texts."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        known, out = self.known, []
        if len(known) > CACHE:
            known.clear()
        for token in _TOKEN.findall((text or "").lower()):
            value = known.get(token)
            if value is None:
                value = known[token] = xxhash.xxh64_intdigest(token)
            out.append(value)
        return np.array(out, np.uint64)


def window_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """The hash of each window of ``tokens`` under a mask."""
    count = len(tokens) - len(mask) + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k, read in enumerate(mask):
        if read == "1":
            out = (out ^ tokens[k:k + count]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def mask_list(masks: tuple[str, ...]) -> list[str]:
    """The masks and, after them, those of short overlaps."""
    return [*masks, *SHORT_MASKS, *FIVE]


def masks_for(n_tokens: int, masks: tuple[str, ...], min_tokens: int = MIN_TOKENS) -> range:
    """The places in ``mask_list`` of the masks that find overlaps with an item of ``n_tokens``."""
    least, long = min(min_tokens, n_tokens), len(masks)
    if n_tokens < SHORT:
        return range(0)
    if least >= COVERED:
        return range(long)
    return range(long, long + len(SHORT_MASKS) + (len(FIVE) if least <= SHORT else 0))


def benchmark_windows(items: DataFrame, masks: tuple[str, ...] = MASKS, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(item_key, item_id, tokens, windows array<struct<mask, hash, at>>)."""
    seeds = mask_list(masks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Tokens()
        for batch in batches:
            tokens = [find(t) for t in batch.column(2).to_pylist()]
            windows = [[{"mask": m, "hash": h, "at": at} for m in masks_for(len(t), masks, min_tokens)
                        for at, h in enumerate(signed64(window_hashes(t, seeds[m])).tolist())] for t in tokens]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([signed64(t) for t in tokens], pa.list_(pa.int64())),
                 pa.array(windows, pa.list_(pa.struct([("mask", pa.int32()), ("hash", pa.int64()), ("at", pa.int32())])))],
                names=["item_key", "item_id", "tokens", "windows"])

    return items.select(F.xxhash64("item_id", "text").alias("item_key"), F.col("item_id").cast("long"), "text").distinct() \
        .mapInArrow(run, "item_key long, item_id long, tokens array<long>, windows array<struct<mask:int,hash:long,at:int>>")


def bitmap_of(index: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bits at ``hash mod 2 ** bits``, as bytes: at most ``2 ** bits / 8`` reach the driver."""
    place = F.pmod("hash", F.lit(2 ** bits))
    rows = index.select(place.alias("p")).groupBy(F.expr(f"p div {ROW_BITS}").alias("row")).agg(
        F.bitmap_construct_agg(F.col("p") % ROW_BITS).alias("bits")).collect()
    out = np.zeros((max(1, 2 ** bits // ROW_BITS), ROW_BITS // 8), np.uint8)
    for r in rows:
        out[r["row"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def regions(docs: DataFrame, bitmap: np.ndarray, masks: tuple[str, ...], used: set[int], around: int = AROUND) -> DataFrame:
    """(row_key, doc_id, start, tokens, hits): the surroundings of windows of the ``used`` masks that the bitmap lets pass."""
    seeds = [(m, seed) for m, seed in enumerate(mask_list(masks)) if m in used]
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, find = shared.value, Tokens()
        size = np.uint64(len(bits) * 8 - 1)  # a power of two
        for batch in batches:
            out: list[tuple] = []
            for key, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = find(text)
                found = []
                for m, seed in seeds:
                    hashes = window_hashes(tokens, seed)
                    place = hashes & size
                    at = np.flatnonzero(bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                    found += [(a, m, h) for a, h in zip(at.tolist(), signed64(hashes[at]).tolist())]
                found.sort()
                k = 0
                while k < len(found):
                    first = k
                    while k + 1 < len(found) and found[k + 1][0] - found[k][0] <= 2 * around:
                        k += 1
                    k += 1
                    start = max(0, found[first][0] - around)
                    end = found[k - 1][0] + max(map(len, mask_list(masks))) + around
                    out.append((key, doc, start, signed64(tokens[start:end]),
                                [{"mask": m, "hash": h, "at": a} for a, m, h in found[first:k]]))
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                 pa.array(columns[3], pa.list_(pa.int64())),
                 pa.array(columns[4], pa.list_(pa.struct([("mask", pa.int32()), ("hash", pa.int64()), ("at", pa.int32())])))],
                names=["row_key", "doc_id", "start", "tokens", "hits"])

    return docs.select(row_key().alias("row_key"), F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "row_key long, doc_id long, start long, tokens array<long>, hits array<struct<mask:int,hash:long,at:int>>")


def longest_alike(equal: np.ndarray, share: float) -> tuple[int, int]:
    """(start, end) of the longest stretch of which at least ``share`` is true."""
    sums = np.concatenate([[0.0], np.cumsum(equal - share)])
    best = (0, 0)
    later = np.maximum.accumulate(sums[::-1])[::-1]  # the largest sum from here on
    end = 0
    for start in range(len(sums)):
        end = max(end, start)
        while end + 1 < len(sums) and later[end + 1] >= sums[start] - 1e-9:
            end += 1
        if end - start > best[1] - best[0]:
            best = (start, end)
    return best


def overlaps(docs: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS, min_tokens: int = MIN_TOKENS,
             min_equal: float = MIN_EQUAL, around: int = AROUND) -> DataFrame:
    """(row_key, doc_id, item_id, start, n_aligned, n_equal): the largest overlap of each row and item that share one."""
    bench = materialize(benchmark_windows(items, masks, min_tokens), "benchmark")
    index = materialize(bench.select("item_key", F.explode("windows").alias("w")).select("item_key", "w.*"), "windows")
    used = {r["mask"] for r in index.select("mask").distinct().collect()}
    found = materialize(regions(docs, bitmap_of(index), masks, used, around).dropDuplicates(["row_key", "start"]), "regions")
    hits = found.select("row_key", "start", F.explode("hits").alias("h")).select(
        "row_key", "start", "h.mask", "h.hash", F.col("h.at").alias("doc_at"))
    aligned = hits.join(index, ["mask", "hash"]).select(
        "row_key", "start", "item_key", (F.col("doc_at") - F.col("at")).cast("long").alias("shift")).distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            key, doc, start, shift, tokens, item_id, item = batch.columns
            for k in range(batch.num_rows):
                a, b = tokens[k].values.to_numpy(), item[k].values.to_numpy()
                offset = shift[k].as_py() - start[k].as_py()  # item position i meets a[i + offset]
                low, high = max(0, -offset), min(len(b), len(a) - offset)
                equal = a[low + offset:high + offset] == b[low:high]
                i, j = longest_alike(equal, min_equal)
                if j - i >= min(min_tokens, len(b)):
                    out.append((key[k].as_py(), doc[k].as_py(), item_id[k].as_py(),
                                start[k].as_py() + low + offset + i, j - i, int(equal[i:j].sum())))
            columns = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["row_key", "doc_id", "item_id", "start", "n_aligned", "n_equal"])

    pairs = aligned.join(found.select("row_key", "doc_id", "start", "tokens"), ["row_key", "start"]).join(
        bench.select("item_key", "item_id", F.col("tokens").alias("item")), "item_key").select(
        "row_key", "doc_id", "start", "shift", "tokens", "item_id", "item")
    best = F.max(F.struct("n_equal", "n_aligned", (-F.col("start")).alias("back"))).alias("best")
    return pairs.mapInArrow(
        verify, "row_key long, doc_id long, item_id long, start long, n_aligned long, n_equal long").groupBy(
        "row_key", "doc_id", "item_id").agg(best).select(
        "row_key", "doc_id", "item_id", (-F.col("best.back")).alias("start"), "best.n_aligned", "best.n_equal")


def decontaminate(docs: DataFrame, items: DataFrame, **options: object) -> DataFrame:
    """``docs`` without the rows that overlap an item."""
    rejected = materialize(overlaps(docs, items, **options).select(F.col("row_key").alias("__row_key")).distinct(), "rejected")
    return drop_rows(docs, rejected)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: every (document, benchmark item) that overlap."""
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")
