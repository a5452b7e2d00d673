"""Line deduplication by an exact set-similarity join, with DataFrame functions only.

A line is its set of lower-cased words. A line is removed if an earlier line (by
doc_id, then line number) is similar: Jaccard of at least ``threshold``.

1. The words of each line are hashed once and written. Words are ordered by rarity: all words of the corpus, each once a line,
   are counted in ``RARITY_BUCKETS`` hash buckets, and each count is kept as one of 95 steps of its logarithm,
   an array of fixed size. A word's order key is the step of its bucket, followed by its hash;
   any order is exact, rare-first is fast.
2. Lines of equal sets are one class, found by one aggregation; a line that a third
   of all documents hold is one class. Only the classes' first lines go on.
3. Prefix filter: similar sets share one of their first ``n - ceil(t n) + 1`` words.
   Classes are joined on these words, under the length filter (``n`` within ``t``) and
   the positional filter (the places of the shared word leave enough words to share) and
   a parity filter (64 parities of each set bound from below how many words differ). By the positional filter a smaller
   set meets larger ones on about half of its prefix.
4. Candidates are verified on their whole sets. Those are made again from the texts, of
   the candidates' first lines only: a bitmap of fixed size lets their lines pass, and
   the join that follows is exact. 128 parities come before the sets, which are many times
   as wide, so sets travel with few pairs that are not similar.
5. A class's first line goes if a similar class has an earlier one; its others go anyway.
   Each class is compared with the earliest class of each of its frequent prefix words first, and only
   those that this leaves open are joined with all earlier classes.
6. Only the texts of documents that may lose a line, as a bitmap of fixed size tells, are shuffled to meet their lines.

Words are compared by 63 bits of their hash. Defined results: lines without a word
and null texts stay; (doc_id, text, line number) identifies a line, so rows that repeat a
doc_id with its text keep and lose the same lines, and different texts of one id, or of
none, are documents of their own, in the order of a hash of their text; a null doc_id comes
last; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.llm.common import let, materialize, release, row_key, table
from tidemark.llm.order import placed

THRESHOLD = 0.8
#: White space between the words of a line, besides the blank.
SPACES = "\t\x0b\x0c\r"
RARITY_BUCKETS = 2 ** 20
#: Steps of a count's logarithm: a third of a power of two each, up to 2^31 and more.
RARITY_STEPS, STEPS_PER_POWER = 95, 3
#: Spark's setting for the number of groups, as a power of two, that an aggregate keeps in its fast map.
FAST_GROUPS = "spark.sql.codegen.aggregate.fastHashAggregateRowMaxCapacityBit"
#: Buckets of one row that reaches the driver.
RARITY_ROW = 1024
#: Parts of the prefix words that are shuffled one after the other to find candidates.
PASSES = 3
#: Bits of the bitmap of candidates' lines, and of one row of Spark's bitmap aggregate.
BITMAP_BITS, ROW_BITS = 2 ** 22, 32_768
#: Bits of the bitmap of documents that lose a line.
DOCUMENT_BITS = 2 ** 25
#: Lines of one document that a line's place has room for, in bits; and documents, if it is a long.
LINE_BITS, MOST_DOCUMENTS = 31, 2 ** 32
#: Words whose step says that they stand so often are frequent: the leaders of rarer ones would spare few pairs.
FREQUENT = 128
FREQUENT_KEY = int(math.log2(FREQUENT) * STEPS_PER_POWER) << 56


def words_of(line: Column) -> Column:
    """The lower-cased words of a line, and empty strings. Only lines with other white space than blanks are rewritten."""
    blanks = reduce(lambda text, space: F.replace(text, F.lit(space), F.lit(" ")), SPACES, line)
    return F.split(F.lower(F.when(line.rlike(f"[{SPACES}]"), blanks).otherwise(line)), " ")


def place(lines: DataFrame) -> Column:
    """A line's place in the order of all ``lines``: doc_id, then the number of the line. A long if the ids are longs."""
    if lines.schema["doc_id"].dataType == LongType():
        return F.shiftleft("doc_id", LINE_BITS).bitwiseOR(F.col("line").cast("long"))
    room = F.lit(str(2 ** LINE_BITS)).cast("decimal(11,0)")
    return (F.col("doc_id") * room + F.col("line").cast("decimal(10,0)")).cast("decimal(38,0)")


def text_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line, content) of every line with a word, ``line`` counting from 0 over all lines."""
    each = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    return each.filter(F.col("content").rlike(f"[^ {SPACES}]"))


def with_hashes(lines: DataFrame) -> DataFrame:
    """``lines`` (with ``content``) and ``hashes``, those of their words, each once."""
    hashes = F.transform(words_of(F.col("content")), lambda w: F.xxhash64(w))
    return lines.withColumn("hashes", F.array_except(hashes, F.array(F.xxhash64(F.lit("")))))


def hashed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line, hashes) of every line with a word."""
    return with_hashes(text_lines(docs)).select("doc_id", "line", "hashes")


def rarity(docs: DataFrame, buckets: int = RARITY_BUCKETS, hashed: DataFrame | None = None) -> Column:
    """A scalar subquery, array<tinyint>: for each hash bucket, a step that rises with the count of its words.

    The counts are of the words of all lines, each once a line (``hashed``, if they are written); the value has ``buckets`` (a power of two) bytes, whatever the corpus. It is
    read from a table of one row where it is used, so plans name it and do not spell it out.
    """
    words = (hashed_lines(docs) if hashed is None else hashed).select(F.explode("hashes").alias("word"))
    each = words.select(F.col("word").bitwiseAND(F.lit(buckets - 1).cast("long")).cast("int").alias("bucket"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    counts = each.union(every).groupBy("bucket").count()  # one more for every bucket
    step = F.least(F.floor(F.log2("count") * STEPS_PER_POWER), F.lit(RARITY_STEPS - 1)).cast("tinyint")
    row = F.sort_array(F.collect_list(F.struct("bucket", step.alias("step"))))
    found = counts.groupBy(F.expr(f"bucket div {RARITY_ROW}").alias("row")).agg(row["step"].alias("steps"))
    rows = F.array_sort(F.collect_list(F.struct("row", "steps")))  # buckets / RARITY_ROW rows
    spark = docs.sparkSession
    before = spark.conf.get(FAST_GROUPS, None)
    spark.conf.set(FAST_GROUPS, str(max(16, buckets.bit_length() - 1)))  # room for all buckets while the words are counted
    try:
        return materialize(found.agg(F.flatten(rows["steps"]).alias("steps")), "rarity").scalar()
    finally:
        spark.conf.unset(FAST_GROUPS) if before is None else spark.conf.set(FAST_GROUPS, before)


def set_of(hashes: Column, steps: Column, buckets: int = RARITY_BUCKETS) -> Column:
    """The set of a line as sorted order keys, rarest first: step of the bucket, then 56 bits of the hash."""
    def key(h: Column) -> Column:
        step = F.get(steps, h.bitwiseAND(F.lit(buckets - 1).cast("long")).cast("int"))
        order = F.shiftleft(step.cast("long"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))
        return F.coalesce(order, F.lit(0).cast("long"))  # never null: sorts as plain longs

    return F.sort_array(F.transform(hashes, key))


def with_sets(lines: DataFrame, steps: Column) -> DataFrame:
    """``lines`` (with ``hashes``) and ``words``, the sets of their lines.

    A subquery must not stand inside a lambda function when a query is analysed, so it gets a column first; the
    optimizer then merges the two selects, and no row holds the value. ``lines`` must not be an aggregate itself, as the
    first select would be merged into that, and each of its rows would hold the value.
    """
    return lines.withColumn("steps", steps).withColumn("words", set_of(F.col("hashes"), F.col("steps"))).drop("steps")


def parity(words: Column) -> Column:
    """64 parities of a set, as a long: sets differ in at least as many words as their parities differ in bits."""
    # a shift of a long takes the last 6 bits of the hash; a lambda is interpreted word by word, so it is kept short
    return F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.hash(w))))


def needed(n: Column, threshold: float) -> Column:
    """ceil(threshold * n), safe from the rounding of the product."""
    return F.ceil(n * threshold - 1e-9).cast("int")


def prefix_word(key: Column) -> Column:
    """A prefix word as an int, odd if the word is frequent."""
    return F.shiftleft(F.hash(key), 1).bitwiseOR((key >= F.lit(FREQUENT_KEY)).cast("int"))


def classes(docs: DataFrame, steps: Column, threshold: float = THRESHOLD, hashed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines, classes): (doc_id, line, id) of lines with words; (id, n, parity, prefix, number) of their classes.

    ``number`` is the place of the class's first line, so classes are ordered by their first lines.
    ``hashed``, if given, are the written ``hashed_lines`` of ``docs``, which go once the lines are written.
    """
    found = with_sets(hashed_lines(docs) if hashed is None else hashed, steps).select("doc_id", "line", "words")
    n = F.size("words")
    prefix = F.transform(F.slice("words", 1, n - needed(n, threshold) + 1), prefix_word)
    lines = materialize(found.select("doc_id", "line", F.xxhash64("words").alias("id"), n.alias("n"),
                                     parity(F.col("words")).alias("parity"), prefix.alias("prefix")), "lines")
    if hashed is not None:
        release(hashed)
    own = materialize(lines.groupBy("id", "n", "parity", "prefix").agg(F.min(place(lines)).alias("number")), "line-classes")
    ids = materialize(lines.select("doc_id", "line", "id"), "line-ids")
    release(lines)
    return ids, own


def prefix_index(own: DataFrame, *more: str) -> DataFrame:
    """A row for each prefix word of each class."""
    return own.select("number", "n", "parity", *more, F.posexplode("prefix").alias("at", "word"))


def passes(a: str, b: str, threshold: float) -> Column:
    """The filters on a pair of index rows of one word."""
    def get(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    n_a, n_b = get(a, "n"), get(b, "n")
    # holds for the first word that a similar pair shares, as its other shared words come later in both
    most = F.least(n_a - get(a, "at"), n_b - get(b, "at"))
    shared = F.ceil((n_a + n_b) * (threshold / (1 + threshold)) - 1e-9)
    differ = F.bit_count(get(a, "parity").bitwiseXOR(get(b, "parity")))
    return ((F.least(n_a, n_b) >= needed(F.greatest(n_a, n_b), threshold)) & (most >= shared)
            & (differ <= n_a + n_b - 2 * shared))


def leader_pairs(own: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (a, b) that pass the filters, a the earliest class of a frequent prefix word they share: a row for each
    class and word at most, however many classes share the word."""
    index = prefix_index(own).filter(F.col("word").bitwiseAND(F.lit(1)) == 1)
    earlier = Window.partitionBy("word").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = ("number", "n", "at", "parity")
    # plain columns up to the window: a struct of them would be made before the shuffle and double its rows
    led = index.select(*names, *[F.first(c).over(earlier).alias(f"first_{c}") for c in names])
    return led.select(F.struct(*names).alias("b"), F.struct(*[F.col(f"first_{c}").alias(c) for c in names]).alias("a")) \
        .filter((F.col("a.number") < F.col("b.number")) & passes("a", "b", threshold)).select(F.col("a.number").alias("a"), F.col("b.number").alias("b")).distinct()


def candidates(own: DataFrame, threshold: float = THRESHOLD) -> list[DataFrame]:
    """Pairs (a, b) that pass the filters, b a class with ``open`` and a any earlier class: a table for each of
    ``PASSES`` parts of the words, written, so a part's shuffle files go before the next part's are made.

    ``passes`` asks that as many words follow the shared word as a pair shares, ceil(t / (1 + t) (n_a + n_b)), which is at
    least ceil(2 t / (1 + t) n) for the smaller set's n. So a smaller set meets larger ones on about half of its prefix.
    """
    s, l = F.col("small.number"), F.col("large.number")
    ordered = (F.col("small.n") < F.col("large.n")) | ((F.col("small.n") == F.col("large.n")) & (s < l))
    wanted = F.when(s < l, F.col("large.open")).otherwise(F.col("small.open"))
    parts = []
    for k in range(PASSES):
        index = prefix_index(own, "open").filter(F.pmod("word", F.lit(PASSES)) == k)
        small = index.filter(F.col("at") <= F.col("n") - needed(F.col("n"), 2 * threshold / (1 + threshold))).alias("small")
        pairs = small.join(index.alias("large"), (F.col("small.word") == F.col("large.word")) & ordered
                           & passes("small", "large", threshold) & wanted)
        parts.append(materialize(pairs.select(F.least(s, l).alias("a"), F.greatest(s, l).alias("b")).distinct(), "line-candidates"))
    return parts


def may_be_in(rows: DataFrame, key: Column, keys: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """``rows`` and ``may``: true if ``key`` is in the one column of ``keys``, false of nearly all others (a bitmap of ``bits``)."""
    bit = F.pmod(F.xxhash64(keys[keys.columns[0]]), F.lit(bits))
    bitmap = keys.select(bit.alias("p")).groupBy(F.expr(f"p div {ROW_BITS}").alias("part")).agg(
        F.bitmap_construct_agg(F.col("p") % ROW_BITS).alias("bits"))  # bits / 8 bytes at most
    each = rows.withColumn("p", F.pmod(F.xxhash64(key), F.lit(bits))).withColumn("part", F.expr(f"p div {ROW_BITS}"))
    byte = f"cast(conv(hex(substring(bits, cast(p % {ROW_BITS} div 8 as int) + 1, 1)), 16, 10) as int)"
    may = F.coalesce(F.expr(f"{byte} & shiftleft(1, cast(p % 8 as int)) <> 0"), F.lit(False))
    return each.join(F.broadcast(bitmap), "part", "left").select(*rows.columns, may.alias("may"))


def among(rows: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``rows`` whose ``key`` may be in the one column of ``keys``: a bitmap lets them all pass, and few others."""
    return may_be_in(rows, key, keys).filter("may").drop("may")


def lines_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(number, content) of the lines whose place is in ``places`` (column ``number``), again for each copy of a row."""
    if docs.schema["doc_id"].dataType == LongType():
        docs = among(docs, F.col("doc_id"), places.select(F.shiftrightunsigned("number", LINE_BITS).alias("doc_id")))
    lines = text_lines(docs)
    passed = among(lines.select(place(lines).alias("number"), "content"), F.col("number"), places)
    return passed.join(places, "number")


def sets_at(docs: DataFrame, places: DataFrame, steps: Column) -> DataFrame:
    """(number, words, n, low, high) of the lines whose place is in ``places``, each once."""
    found = with_sets(with_hashes(lines_at(docs, places)), steps).select("number", "words").dropDuplicates(["number"])
    return found.select("number", "words", F.size("words").alias("n"), *parities(F.col("words")))


def numbers(pairs: DataFrame) -> DataFrame:
    """(number) of the classes of ``pairs`` (a, b), each once."""
    return pairs.select(F.col("a").alias("number")).union(pairs.select("b")).distinct()


def parities(words: Column) -> list[Column]:
    """128 parities of a set, as the longs ``low`` and ``high``; those of ``parity`` are these two, combined by xor."""
    def half(bit: int) -> Column:
        return parity(F.filter(words, lambda w: w.bitwiseAND(F.lit(64).cast("long")) == bit))

    return [half(0).alias("low"), half(64).alias("high")]


def nearer(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets (number, n, low, high) differ in few enough of 128 parities."""
    each = pairs
    for side in ("a", "b"):
        each = each.join(sets.select(F.col("number").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "low", "high")]), side)
    both = F.col("n_a") + F.col("n_b")
    shared = F.ceil(both * (threshold / (1 + threshold)) - 1e-9)
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in ("low", "high")])
    return each.filter(differ <= both - 2 * shared).select("a", "b")


def similar(docs: DataFrame, pairs: DataFrame, steps: Column, threshold: float = THRESHOLD) -> DataFrame:
    """Those of ``pairs`` (a, b: numbers of classes) that are similar, with ``shared`` words and ``jaccard``, written."""
    pairs = materialize(pairs, "line-pairs")
    places = materialize(numbers(pairs), "line-places")
    sets = materialize(sets_at(docs, places, steps), "line-sets")
    near = materialize(nearer(pairs, sets, threshold), "line-near")
    release(pairs, places)
    whole = among(sets.select("number", "words"), F.col("number"), numbers(near))
    shared = F.size(F.array_intersect("wa", "wb"))
    both = F.size("wa") + F.size("wb")
    found = near.join(whole.select(F.col("number").alias("a"), F.col("words").alias("wa")), "a") \
        .join(whole.select(F.col("number").alias("b"), F.col("words").alias("wb")), "b") \
        .select("a", "b", shared.alias("shared"), (shared / (both - shared)).alias("jaccard")) \
        .filter(F.col("jaccard") >= threshold - 1e-12)
    found = materialize(found, "line-similar")
    release(near, sets)
    return found


def later_classes(docs: DataFrame, own: DataFrame, steps: Column, threshold: float = THRESHOLD) -> DataFrame:
    """(number) of the classes that are similar to an earlier one.

    One earlier match is enough. So classes are compared with the earliest class of each of their frequent prefix
    words first, which settles large groups of near copies in a number of pairs that grows with the group and
    not with its square; only classes that are still open are joined with all earlier ones. A group whose words
    are not frequent has fewer than ``FREQUENT`` classes. ``own``, a written table, goes once the candidates are found.
    """
    settled = materialize(similar(docs, leader_pairs(own, threshold), steps, threshold)
                          .select(F.col("b").alias("number")).distinct(), "line-settled")
    marked = own.join(settled.withColumn("settled", F.lit(True)), "number", "left").withColumn("open", F.col("settled").isNull())
    parts = candidates(marked, threshold)
    release(own)
    rest = similar(docs, reduce(DataFrame.union, parts).distinct(), steps, threshold).select(F.col("b").alias("number")).distinct()
    release(*parts)
    return settled.union(rest)


def removed_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, removed array<int>): the lines of each document that an earlier line matches."""
    hashed = materialize(hashed_lines(docs), "line-hashes")
    steps = rarity(docs, hashed=hashed)
    lines, own = classes(docs, steps, threshold, hashed)
    first = materialize(own.select("id", "number"), "line-numbers")
    later = later_classes(docs, own, steps, threshold)
    gone = first.join(later.withColumn("matched", F.lit(True)), "number", "left")
    removed = materialize(lines.join(gone, "id").filter((place(lines) != F.col("number")) | F.col("matched"))
                          .groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("removed")), "removed-lines")
    release(lines, first)
    return removed


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text) of ``docs``: each row as a struct, and ids that hold one text each and are never null.

    Ids that hold one text each stay: as longs from 0 to ``MOST_DOCUMENTS`` - 1, or else as decimals, of which null is
    the last. If one id, or none, has several texts, all documents are numbered in the order of their ids (null: last)
    and then of a hash of their text.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text",
                       row_key().alias("key"))
    keys = rows.select("doc_id", "key")
    narrow = F.coalesce((F.col("doc_id") >= 0) & (F.col("doc_id") < MOST_DOCUMENTS), F.lit(False))
    found = rows.groupBy("doc_id").count().agg(F.max(F.col("count") > 1).alias("repeated"), F.min(narrow).alias("narrow")).first()
    # texts are read for this only if an id repeats
    several = found["repeated"] and not keys.groupBy("doc_id").agg((F.min("key") != F.max("key")).alias("several")).filter("several").isEmpty()
    if several:
        order = placed(keys.distinct().withColumn("no_id", F.col("doc_id").isNull()), ["no_id", "doc_id", "key"], "line-documents")
        return materialize(rows.drop("doc_id").join(order.select("key", F.col("place").alias("doc_id")), "key")
                           .select("row", "doc_id", "text"), "numbered")
    if found["narrow"]:
        return rows.drop("key")
    wide = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(2 ** 63)).cast("decimal(20,0)"))
    return rows.drop("key").withColumn("doc_id", wide)


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the lines that an earlier line matches, and ``n_removed``; a column of this name is replaced."""
    own = [c for c in docs.columns if c != "n_removed"]
    rows = numbered(docs)
    removed = removed_lines(rows.select("doc_id", "text"), threshold)
    rows = may_be_in(rows, F.col("doc_id"), removed.select("doc_id"), DOCUMENT_BITS)
    joined = rows.filter("may").join(removed, "doc_id", "left").unionByName(
        rows.filter("not may").withColumn("removed", F.lit(None).cast("array<int>")))

    def rest(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "removed")
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    cleaned = F.when(F.col("removed").isNull(), F.col("text")).otherwise(let(F.split("text", "\n"), rest))
    return joined.select(*[cleaned.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in own],
                         F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: all documents without repeated lines."""
    return deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
