"""Near-duplicate documents by an exact Jaccard join over a token-group matrix.

A document is its set of different word shingles, as 64-bit hashes. Two documents
link when their sets' Jaccard similarity is at least ``percent`` hundredths.

1. Equal sets are one class, found by one aggregation; everything below works on classes.
2. Shingles are ordered by rarity (counts of all documents' shingles in a table of
   ``BUCKETS`` hash buckets, kept as steps of their logarithm). In any one order, similar sets
   share ``least(n)`` of their first ``n - ceil(t n) + least(n)`` shingles, so a class that has
   fewer first shingles in common with all other classes together has no link.
3. The other classes are sorted by min-hashes of their sets and cut into groups of
   ``GROUP`` neighbours, so that similar documents share a group. The token-group
   matrix holds which group has which shingle.
4. A group is opened for a query by its row of the matrix: a query that has less than
   ``t`` of its shingles in the group's union can be similar to no member. For the others
   the same look-up gives the overlap with every member, and Jaccard is verified.
5. Only connectivity is asked for, so classes that are linked already are not compared
   again: first each group is opened for its own members, then, ``PILOTS`` times, for each first
   shingle of a class ``LEADERS`` of the groups that have it, and then, for each pair of a class
   and a group that share a first shingle at places that leave enough to share, and lie in
   different components, the group. The last step is exact; the others leave it little. A query is of the smaller component,
   so that a large group of copies is not compared with itself.

A group with many queries is opened by several tasks, ``QUERIES`` queries each. Sets are
compared by their shingles' 64-bit hashes.

Defined results: texts with fewer words than a shingle are one shingle; null and blank
texts have an empty set and link with nothing, not even each other; rows that repeat an
id are documents of their own; null ids do not count for component_id, which is null only
if a component has no other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, materialize_parts, release, table
from tidemark.llm.graph import components
from tidemark.llm.order import placed

SHINGLE = 4
PERCENT = 85
#: Classes of one group.
GROUP = 32
#: Rounds before the exact one, and the groups that a shingle leads to in each.
PILOTS, LEADERS = 1, 8
#: Queries that one task compares with a group.
QUERIES = 1024
#: One in so many shingles must be shared among the first ones, and one more.
LEAST = 20
#: Parts of the shingles, of the sets before and of the groups opened after, that are shuffled one after the other.
PASSES = 3
#: Hash buckets whose shingles are counted, and buckets of one row of counts.
BUCKETS, ROW = 2 ** 18, 2 ** 12
#: Bits of the bitmap of documents whose sets are made again, and of one row of Spark's bitmap aggregate.
BITS, ROW_BITS = 2 ** 24, 32_768
#: Bits of the bitmap of queries.
QUERY_BITS = 2 ** 22
#: Words whose hashes a task remembers.
WORDS = 1_000_000
#: Odd multipliers: of a word's place in a shingle, and of the min-hashes' orders.
MIX = np.uint64(0x9E3779B97F4A7C15)
ORDERS = tuple(np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


class WordHashes(dict):
    """The hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def scrambled(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * ORDERS[0]
    return values ^ (values >> np.uint64(29))


def shingles(text: bytes | None, hashes: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """The different shingles of a text, as sorted 64-bit hashes."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(shingle, len(words))
    count = len(words) - width + 1
    found = np.full(count, width, np.uint64)
    for k in range(width):
        found = scrambled(found * MIX + each[k:k + count])
    return np.unique(found)


def bucket_counts(docs: DataFrame, shingle: int = SHINGLE) -> np.ndarray:
    """How many documents' shingles fall into each bucket, as steps of a third of a power of two (bytes)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = WordHashes(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            sets = [shingles(t, hashes, shingle) for t in batch.column(0).to_pylist()]
            if sets:
                np.add.at(total, (np.concatenate(sets) % np.uint64(BUCKETS)).astype(np.int64), 1)
        yield as_rows(total)

    def as_rows(total: np.ndarray) -> pa.RecordBatch:
        kept = [r for r in range(BUCKETS // ROW) if total[r * ROW:(r + 1) * ROW].any()]
        return pa.RecordBatch.from_arrays(
            [pa.array(kept, pa.int32()),
             pa.array([zlib.compress(total[r * ROW:(r + 1) * ROW].tobytes(), 1) for r in kept], pa.binary())], names=["row", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for row, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[row * ROW:(row + 1) * ROW] += np.frombuffer(zlib.decompress(counts), np.int64)
        steps = np.minimum(np.log2(total + 1) * 3, 255).astype(np.uint8)
        yield as_rows(steps)

    schema = "row int, counts binary"
    parts = docs.select(F.col("text").cast("binary")).mapInArrow(count, schema)
    steps = np.zeros(BUCKETS, np.uint8)
    for row in parts.repartition("row").mapInArrow(add, schema).collect():  # a byte for each bucket, whatever the corpus
        steps[row["row"] * ROW:(row["row"] + 1) * ROW] = np.frombuffer(zlib.decompress(row["counts"]), np.uint8)
    return steps


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """How many first shingles of a set of ``n`` are looked at."""
    return min(n, n - -(-percent * n // 100) + 1 + n // LEAST)


def least(n: Column, percent: int = PERCENT) -> Column:
    """How many of them a similar set shares, of the sizes that such a set can have."""
    return 1 + F.floor(F.ceil(n * percent / 100) / LEAST)


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64, copy=False).view(np.int64)


def lists(arrays: list[np.ndarray]) -> pa.Array:
    """Arrays of uint64 as one Arrow list array of the same bits."""
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(np.concatenate([*arrays, np.empty(0, np.uint64)]))))


def sketches(docs: DataFrame, steps: np.ndarray, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, row, n, c1, c2, s1, s2, prefix): for each document its set's size, 128-bit hash, min-hashes and first shingles."""
    sent = docs.sparkSession.sparkContext.broadcast(steps)  # BUCKETS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rank = WordHashes(), sent.value
        for batch in batches:
            sizes, whole, low, prefixes = [], [], [], []
            for text in batch.column(2).to_pylist():
                own = shingles(text, hashes, shingle)
                sizes.append(len(own))
                whole.append(xxhash.xxh3_128_digest(own.tobytes()))
                if len(own):
                    low.append([own[np.argmin(own * m)] for m in ORDERS])
                    order = np.lexsort((own, rank[(own % np.uint64(BUCKETS)).astype(np.int64)]))
                    prefixes.append(own[order[:prefix_size(len(own), percent)]])
                else:
                    low.append([np.uint64(0)] * len(ORDERS))
                    prefixes.append(own)
            both = np.frombuffer(b"".join(whole), np.int64).reshape(-1, 2)
            signs = signed(np.array(low, np.uint64).reshape(-1, len(ORDERS)).ravel()).reshape(-1, len(ORDERS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()),
                 pa.array(signs[:, 0].copy()), pa.array(signs[:, 1].copy()), lists(prefixes)],
                names=["doc_id", "row", "n", "c1", "c2", "s1", "s2", "prefix"])

    return docs.select(F.col("doc_id").cast("long"), row_hash().alias("row"), F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, row long, n long, c1 long, c2 long, s1 long, s2 long, prefix array<long>")


def row_hash() -> Column:
    """A number of a document's row, which finds its text again; rows that share one are told apart by their sets."""
    return F.xxhash64("doc_id", "text")


def distinct_sets(sketched: list[DataFrame]) -> tuple[list[DataFrame], DataFrame]:
    """The classes of equal sets in each table of ``sketched``, with a ``number`` of their own; (doc_id, row, n, c1, c2)
    of all documents; all written.

    Equal sets are in one table. Its first shingles, most of what a document brings, are shuffled and written
    again; each table goes once its classes are written, so no two copies of all first shingles lie on disk.
    """
    classes, sizes = [], []
    for k, part in enumerate(sketched):
        own = part.filter("n > 0").groupBy("c1", "c2").agg(
            F.min("doc_id").alias("first_id"), F.min("row").alias("row"), *[F.first(c).alias(c) for c in ("n", "s1", "s2", "prefix")])
        classes.append(materialize(own.withColumn("number", F.monotonically_increasing_id() * len(sketched) + k), "classes-and-prefixes"))
        sizes.append(materialize(part.select("doc_id", "row", "n", "c1", "c2"), "sizes"))
        release(part)
    return classes, reduce(DataFrame.union, sizes)


def sharing(classes: DataFrame, percent: int = PERCENT) -> tuple[list[DataFrame], DataFrame]:
    """(token, at, number), a table for each of ``PASSES`` parts of the shingles: the first shingles that several of
    ``classes`` have; (number) of the classes that have enough of them; all written.

    A shuffle by shingle: a class has a shingle once, so one that has a neighbour in the order of its classes has
    several. Rows of a frequent shingle are sorted and buffered on disk where memory ends. Most first shingles are
    found once, so the shuffle is many times its result; each part's shuffle files go before the next part's are made.
    """
    postings = classes.select(F.posexplode("prefix").alias("at", "token"), "number")
    neighbours = Window.partitionBy("token").orderBy("number")
    several = F.lag("number").over(neighbours).isNotNull() | F.lead("number").over(neighbours).isNotNull()
    shared = [materialize(postings.filter(F.pmod("token", F.lit(PASSES)) == k).withColumn("several", several)
                          .filter("several").drop("several"), "sharing") for k in range(PASSES)]
    alive = reduce(DataFrame.union, shared).groupBy("number").count().join(classes.select("number", "n"), "number").filter(
        F.col("count") >= least(F.col("n"), percent)).select("number")
    return shared, materialize(alive, "alive")


def between_groups(shared: DataFrame, members: DataFrame) -> DataFrame:
    """(token, at, id, group, n): the shared first shingles of ``members`` that stand in several groups, written."""
    each = shared.join(members.select("number", "id", "group", "n"), "number").drop("number")
    own = Window.partitionBy("token")
    several = F.min("group").over(own) != F.max("group").over(own)
    return materialize(each.withColumn("several", several).filter("several").drop("several"), "postings")


def among(rows: DataFrame, keys: DataFrame, key: str = "row", bits: int = BITS) -> DataFrame:
    """``rows`` whose ``key`` may be one of ``keys``': a bitmap of ``bits`` bits lets them all pass, and few others."""
    bit = F.pmod(F.xxhash64(key), F.lit(bits))
    bitmap = keys.select(bit.alias("p")).groupBy(F.expr(f"p div {ROW_BITS}").alias("part")).agg(
        F.bitmap_construct_agg(F.col("p") % ROW_BITS).alias("bits"))
    byte = f"cast(conv(hex(substring(bits, cast(p % {ROW_BITS} div 8 as int) + 1, 1)), 16, 10) as int)"
    return rows.withColumn("p", bit).withColumn("part", F.expr(f"p div {ROW_BITS}")).join(F.broadcast(bitmap), "part") \
        .filter(F.expr(f"{byte} & shiftleft(1, cast(p % 8 as int)) <> 0")).select(*rows.columns)


def member_sets(docs: DataFrame, members: DataFrame, repeated: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, group, tokens): the sets of ``members`` (id, group, row, c1, c2), made again from their texts, written.

    ``repeated`` has the ``row`` of documents that stand several times with their id and text.
    """
    texts = among(docs.select(row_hash().alias("row"), F.col("text").cast("binary").alias("text")), members)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, hashes, shingle) for t in batch.column(4).to_pylist()]
            wanted = np.stack([batch.column(k).to_numpy() for k in (2, 3)], 1)
            own = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
            same = (wanted == own).all(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(same)), batch.column(1).filter(pa.array(same)),
                 lists([s for s, ok in zip(sets, same) if ok])], names=["id", "group", "tokens"])

    wanted = members.select("id", "group", "c1", "c2", "row")
    found = wanted.join(texts, "row")
    if not repeated.isEmpty():
        again = wanted.join(texts.join(repeated, "row", "left_semi"), "row").dropDuplicates(["id"])
        found = found.join(repeated, "row", "left_anti").unionByName(again)
    return materialize(found.select("id", "group", "c1", "c2", "text").mapInArrow(run, "id long, group long, tokens array<long>"), "members")


class Opened:
    """A group: its row of the token-group matrix, as sorted shingles and whose they are."""

    def __init__(self, labels: list[int], sets: list[np.ndarray]):
        self.labels, self.sets = np.array(labels, np.int64), sets
        self.sizes = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate(sets)
        order = np.argsort(every, kind="stable")
        self.tokens = every[order]
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]

    def similar(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Which members are similar to ``query``: none where the bound by the group's union fails."""
        first, last = (np.searchsorted(self.tokens, query, side) for side in ("left", "right"))
        times = last - first
        if 100 * np.count_nonzero(times) < percent * len(query):
            return np.zeros(len(self.sets), bool)
        hits = np.repeat(first - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
        shared = np.bincount(self.owner[hits], minlength=len(self.sets))
        return 100 * shared >= percent * (len(query) + self.sizes - shared)


def open_groups(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between labels that ``rows`` (group, chunk, query, label, tokens) hold, each once.

    In each (group, chunk) every query is compared with the members; without a query, the members with each other.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()
        at, labels, sets, group, queried = None, [], [], None, False

        def edges() -> pa.RecordBatch:
            pairs = np.array(list(found), np.int64).reshape(-1, 2)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

        def among() -> None:
            if labels and not queried:
                own = Opened(labels, sets)
                for k, tokens in enumerate(sets):
                    link(labels[k], own, tokens)

        def link(label: int, opened: Opened, tokens: np.ndarray) -> None:
            for other in np.unique(opened.labels[opened.similar(tokens, percent)]).tolist():
                if other != label:
                    found.add((min(label, other), max(label, other)))

        for batch in batches:
            ends = batch.column(4).offsets.to_numpy()
            values = batch.column(4).values.to_numpy()
            for k, key in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                tokens = values[ends[k]:ends[k + 1]]
                if key[:2] != at:
                    among()
                    at, labels, sets, group, queried = key[:2], [], [], None, False
                if key[2]:
                    if group is None:
                        group, queried = Opened(labels, sets), True
                    link(key[3], group, tokens)
                else:
                    labels.append(key[3])
                    sets.append(tokens.copy())
            yield edges()
        among()
        yield edges()

    dealt = rows.repartition("group", "chunk").sortWithinPartitions("group", "chunk", "query")
    return dealt.select("group", "chunk", "query", "label", "tokens").mapInArrow(run, "a long, b long").distinct()


def opened_for(pairs: DataFrame, sets: DataFrame, labels: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links between the labels of ``pairs`` (id, group): each class is compared with the members of the group.

    The groups are opened in ``PASSES`` parts, as a part's shuffle files, which hold sets, go before the next part's are
    made. Sets are shuffled by class for queries only: members are named by their ids, which get labels afterwards.
    """
    pairs = materialize(pairs.join(labels, "id"), "group-queries")
    found = []
    for k in range(PASSES):
        part = pairs.filter(F.pmod("group", F.lit(PASSES)) == k)
        chunks = part.groupBy("group").agg(F.ceil(F.count("*") / QUERIES).alias("chunks"))
        members = sets.filter(F.pmod("group", F.lit(PASSES)) == k).join(chunks, "group").select(
            "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(False).alias("query"),
            F.col("id").alias("label"), "tokens")
        wanted = among(sets.select("id", "tokens"), part, "id", QUERY_BITS)
        queries = part.join(chunks, "group").join(wanted, "id").select(
            "group", F.pmod("id", "chunks").alias("chunk"), F.lit(True).alias("query"), "label", "tokens")
        found.append(materialize(open_groups(members.unionByName(queries), percent), "group-links"))
    release(pairs)
    links = reduce(DataFrame.union, found)
    for end in ("a", "b"):  # a label is the id of a class that has it
        links = links.join(labels.select(F.col("id").alias(end), F.col("label").alias(f"label_{end}")), end)
    return links.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).filter("a <> b").distinct()


def relabelled(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (id, label) after the labels that ``edges`` (a, b) link have become one, written."""
    step = components(edges).select(F.col("node").alias("label"), F.col("label").alias("lower"))
    return materialize(labels.join(step, "label", "left").select("id", F.coalesce("lower", "label").alias("label")), "group-labels")


def class_labels(sets: DataFrame, postings: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, label) of the classes in ``sets`` (id, group, tokens): equal labels for classes that links connect."""
    own = sets.select("group", F.lit(0).cast("long").alias("chunk"), F.lit(False).alias("query"), F.col("id").alias("label"), "tokens")
    links = materialize(open_groups(own, percent), "group-links")
    labels = relabelled(sets.select("id", F.col("id").alias("label")), links)

    # only shingles of many groups: of the others the exact round tries every group anyway
    wide = postings.groupBy("token").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count("*").alias("rows")) \
        .filter((F.col("rows") > LEADERS) & (F.col("high") - F.col("low") >= LEADERS)).select("token")
    hot = materialize(postings.join(wide, "token"), "wide-postings")
    for turn in range(0 if hot.isEmpty() else PILOTS):
        each = hot.join(labels, "id")
        rows = each.groupBy("token", "group").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        first = Window.partitionBy("token").orderBy(F.xxhash64("group", F.lit(turn)))
        few = rows.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= LEADERS).drop("at")
        pairs = each.withColumnRenamed("group", "own").join(few, "token").filter(
            (F.col("own") != F.col("group")) & ((F.col("low") != F.col("label")) | (F.col("high") != F.col("label"))))
        labels = relabelled(labels, opened_for(enough(pairs, percent), sets, labels, percent))

    weight = labels.groupBy("label").agg(F.count("*").alias("size"))
    ranked = labels.join(weight, "label").select("id", F.struct("size", "label").alias("part"))
    # similar x and y overlap in t (|x| + |y|) / (1 + t) shingles at least, and from the first that they share, at places
    # i and j, in |x| - i and |y| - j at most; so t |y| <= |x| - (1 + t) i, the reach of x at its place, and the reverse
    reach = 100 * F.col("n") - (100 + percent) * F.col("at")
    each = postings.withColumn("reach", reach).filter(F.col("reach") >= percent * percent / 100 * F.col("n")).join(ranked, "id")
    rows = each.groupBy("token", "group").agg(F.max("part").alias("largest"), F.min("n").alias("least"), F.max("reach").alias("most"))
    split = rows.groupBy("token").agg(F.count("*").alias("groups"), F.max("largest").alias("top")).filter("groups > 1")
    queries = each.join(split.select("token", "top"), "token").filter(F.col("part") < F.col("top")).select(
        "token", "id", "n", "reach", "part", F.col("group").alias("own"))
    pairs = queries.join(rows, "token").filter(
        (F.col("part") < F.col("largest")) & (F.col("own") != F.col("group"))
        & (F.col("most") >= percent * F.col("n")) & (F.col("reach") >= percent * F.col("least")))
    return relabelled(labels, opened_for(pairs.select("id", "group").distinct(), sets, labels, percent))


def enough(pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, group) of ``pairs`` (token, id, group, n) that share as many first shingles as similar sets do."""
    return pairs.groupBy("id", "group").agg(F.count("*").alias("count"), F.min("n").alias("n")).filter(
        F.col("count") >= least(F.col("n"), percent)).select("id", "group")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, group: int = GROUP) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    sketched = sketches(docs, bucket_counts(docs, shingle), shingle, percent)
    numbered_parts, found = distinct_sets(materialize_parts(sketched, "sketches", F.pmod("c1", F.lit(PASSES)), PASSES))
    numbered = reduce(DataFrame.union, numbered_parts)
    shared, alive = sharing(numbered, percent)
    classes = materialize(numbered.drop("prefix"), "classes")
    release(*numbered_parts)
    members = placed(classes.join(alive, "number", "left_semi"), ["s1", "s2", "n"], "live").select(
        F.col("place").alias("id"), F.expr(f"place div {group}").alias("group"), "number", "c1", "c2", "row", "n", "first_id")
    members = materialize(members, "grouped")
    postings = between_groups(reduce(DataFrame.union, shared), members)
    release(*shared, alive)
    repeated = materialize(found.groupBy("row").count().filter("count > 1").select("row"), "repeated")
    sets = member_sets(docs, members, repeated, shingle)
    labels = class_labels(sets, postings, percent)
    release(sets, postings)
    linked = members.join(labels, "id").select("c1", "c2", "label", "first_id")
    firsts = linked.groupBy("label").agg(F.min("first_id").alias("lowest"))
    lowest = linked.join(firsts, "label").select("c1", "c2", "lowest")
    ends = materialize(classes.select("c1", "c2", "first_id").join(lowest, ["c1", "c2"], "left")
                       .select("c1", "c2", F.coalesce("lowest", "first_id").alias("component_id")), "class-components")
    release(classes, members, labels)
    out = found.select("doc_id", "n", "c1", "c2").join(ends, ["c1", "c2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: set size and component of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                 ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')))) END AS own
  FROM worded
), classes AS (
  SELECT own, MIN(doc_id) AS id, len(own) AS n FROM sets WHERE len(own) > 0 GROUP BY own
), parts AS (
  SELECT id, n, unnest(own) AS shingle FROM classes
), links AS (
  SELECT a.id AS a, b.id AS b FROM parts AS a JOIN parts AS b ON a.shingle = b.shingle AND a.id <> b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * COUNT(*) >= 85 * (a.n + b.n - COUNT(*))
), reached AS (
  SELECT id AS a, id AS b FROM classes
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
), lowest AS (
  SELECT a AS id, MIN(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, len(sets.own) AS n_shingles, COALESCE(component_id, doc_id) AS component_id
FROM sets LEFT JOIN classes ON classes.own = sets.own LEFT JOIN lowest ON lowest.id = classes.id
"""
