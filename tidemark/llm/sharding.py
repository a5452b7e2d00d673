"""Sharding by balanced label propagation, with DataFrame functions only.

Documents are linked if they share a link key (here: equal texts). Link keys of more
than a ``BIG``-th of a shard are placed first, whole while a shard has room for them; one
larger than a shard fills one shard after another. The other linked documents start in
shards by hash. In each round the documents of a link key prefer the shard that holds
most of their neighbours. What two shards want from each other is exchanged in equal
counts, which needs no room; moves beyond that go into free room. They are accepted
in the order of neighbours gained (in steps of its logarithm). Equal texts are
interchangeable, so rounds run on counts by (link key, shard), a row for at most
``shards`` parts of each key, however many documents it has. Rounds end when they accept
less than a tenth of what is wanted; the keys that are then still cut are packed whole
into the room that the others leave. A key stays cut only if no shard has room for it.

Documents without a link have no preference and fill what is left, which makes
the law ``rows`` exact: counts of shards differ by at most one.

Prefix ranks run within hash buckets with offsets from the bucket sums, so no
task holds a whole shard or a whole link group.

Defined results: a null text counts as empty; null doc_ids are placed like any
other; equal rows get slots of their own; an empty table gives an empty result;
other columns are ignored by ``shards`` and kept by ``sharded_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import attach, materialize, row_key, table

SHARDS = 40
#: Bytes that a document has besides its text.
OVERHEAD = 16
#: Link keys of more than this part of a shard are placed by the driver: at most 2 * BIG * shards.
BIG = 4
#: A round that accepts less than this part of the wanted moves is the last.
LEAST_ACCEPTED = 0.1
#: Prefix sums run within this many hash buckets.
BUCKETS = 1024
KEY = ["link", "text_crc32"]


def linked_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, size, text_crc32, link): link is equal for equal texts."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long"), row_key().alias("row_key"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("link"))


def ranked(rows: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: their rank from 0 among equal ``by``, through bucket counts and offsets.

    Every group of ``by`` is spread over ``BUCKETS`` by ``spread``, a hash column of ``rows``.
    """
    spread = rows.withColumn("__bucket", F.pmod("spread", F.lit(BUCKETS)))
    keys = [*by, "__bucket"]
    sums = spread.groupBy(*keys).agg(F.count("*").alias("__n"))
    starts = sums.withColumn("__start", F.sum("__n").over(W.partitionBy(*by).orderBy("__bucket")) - F.col("__n"))
    inside = F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1
    return spread.withColumn("__in", inside).join(starts.drop("__n"), keys).withColumn(
        name, (F.col("__start") + F.col("__in")).cast("long")).drop("__bucket", "__start", "__in")


def quota(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def loads(cells: DataFrame, shards: int) -> list[int]:
    """Rows of each shard; one number for each shard reaches the driver."""
    found = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def running(rows: DataFrame, by: list[str], first: Column) -> DataFrame:
    """``rows`` with ``upto``: the running sum of ``n`` among equal ``by``, by ``first`` and then by a hash of the key."""
    spread = rows.withColumn("__bucket", first.cast("long") * BUCKETS + F.pmod(F.xxhash64(*KEY, F.lit("running")), F.lit(BUCKETS)))
    keys = [*by, "__bucket"]
    sums = spread.groupBy(*keys).agg(F.sum("n").alias("__n"))
    starts = sums.withColumn("__start", F.sum("__n").over(W.partitionBy(*by).orderBy("__bucket")) - F.col("__n")).drop("__n")
    inside = F.sum("n").over(W.partitionBy(*keys).orderBy(*KEY).rowsBetween(W.unboundedPreceding, 0))
    return spread.withColumn("__in", inside).join(starts, keys).withColumn(
        "upto", F.col("__start") + F.col("__in")).drop("__bucket", "__start", "__in")


def settle(sizes: list[int], rooms: list[int]) -> list[list[tuple[int, int]]]:
    """(shard, n) parts for groups of these sizes, each in the smallest room that holds it or else in the largest rooms.

    ``rooms`` are lowered by what is placed.
    """
    out = []
    for size in sizes:
        parts = []
        while size:
            fit = [(room, s) for s, room in enumerate(rooms) if room >= size]
            shard = min(fit)[1] if fit else max(range(len(rooms)), key=lambda s: (rooms[s], -s))
            n = min(size, rooms[shard])
            parts.append((shard, n))
            rooms[shard] -= n
            size -= n
        out.append(parts)
    return out


def settled(groups: DataFrame, rooms: list[int]) -> DataFrame:
    """(link, text_crc32, shard, n) of a few groups (link, text_crc32, n), the largest first; ``rooms`` are lowered."""
    found = sorted(((r["n"], r["link"], r["text_crc32"]) for r in groups.collect()), key=lambda g: (-g[0], *g[1:]))
    rows = [(link, crc, s, n) for (_, link, crc), parts in zip(found, settle([g[0] for g in found], rooms)) for s, n in parts]
    return groups.sparkSession.createDataFrame(rows, "link long, text_crc32 long, shard int, n long")


def shard_at(rooms: list[int], place: Column) -> Column:
    """The shard of a place from 0, if places fill the rooms one after another."""
    return F.size(F.filter(longs([sum(rooms[:s + 1]) for s in range(len(rooms))]), lambda end: end <= place))


def flows(wanted: list[list[int]], room: list[int]) -> list[list[int]]:
    """Moves to accept from shard to shard: equal counts between two shards, and then what room there is."""
    shards = range(len(room))
    accepted = [[min(wanted[s][t], wanted[t][s]) for t in shards] for s in shards]
    room = list(room)
    for t in sorted(shards, key=lambda t: -room[t]):
        for s in sorted(shards, key=lambda s: room[s]):  # the fullest first
            n = max(0, min(wanted[s][t] - accepted[s][t], room[t]))
            accepted[s][t] += n
            room[t] -= n
            room[s] += n
    return accepted


def propagate(cells: DataFrame, quotas: list[int]) -> DataFrame:
    """Balanced label propagation over (link, text_crc32, shard, n); counts by pair of shards reach the driver."""
    shards, load, turn = len(quotas), loads(cells, len(quotas)), 0
    while True:
        turn += 1
        parts = cells.withColumn("tie", F.xxhash64("link", "shard", F.lit(turn)))
        best = F.max(F.struct("n", "tie", "shard")).over(W.partitionBy(*KEY))
        moves = materialize(parts.withColumn("best", best).filter(F.col("shard") != F.col("best.shard")).select(
            *KEY, "n", F.col("shard").alias("source"), F.col("best.shard").alias("shard"),
            (F.col("best.n") - F.col("n")).alias("gain")), "moves")
        wanted = [[0] * shards for _ in quotas]
        for r in moves.groupBy("source", "shard").agg(F.sum("n").alias("n")).collect():
            wanted[r["source"]][r["shard"]] = r["n"]
        accept = flows(wanted, [q - x for q, x in zip(quotas, load)])
        n_accepted, n_wanted = sum(map(sum, accept)), sum(map(sum, wanted))
        if not n_accepted:
            return cells
        limit = F.get(longs([n for row in accept for n in row]), F.col("source") * shards + F.col("shard"))
        taken = running(moves, ["source", "shard"], 63 - F.floor(F.log2(F.col("gain") + 1))).withColumn(
            "n", F.least("n", limit - (F.col("upto") - F.col("n")))).filter("n > 0").select(*KEY, "source", "shard", "n")
        moved = taken.select(*KEY, F.explode(F.array(
            F.struct("shard", "n"), F.struct(F.col("source").alias("shard"), (-F.col("n")).alias("n")))).alias("m")).select(*KEY, "m.*")
        cells = materialize(cells.unionByName(moved).groupBy(*KEY, "shard").agg(F.sum("n").alias("n")).filter("n > 0"), "cells")
        load = [x + sum(accept[s][t] - accept[t][s] for s in range(shards)) for t, x in enumerate(load)]
        if n_accepted < LEAST_ACCEPTED * n_wanted:
            return cells


def packed(cells: DataFrame, quotas: list[int]) -> DataFrame:
    """``cells`` with the keys that are cut, or beyond a shard's quota, placed anew, whole where a shard has room."""
    alone = cells.withColumn("parts", F.count("*").over(W.partitionBy(*KEY)))
    whole = running(alone.filter("parts = 1").drop("parts"), ["shard"], F.lit(0))
    stays = F.col("upto") <= F.get(longs(quotas), F.col("shard"))
    whole = materialize(whole.withColumn("stays", stays).drop("upto"), "whole")
    kept = whole.filter("stays").select(*KEY, "shard", "n")
    cut = alone.filter("parts > 1").groupBy(*KEY).agg(F.sum("n").alias("n"))
    cut = cut.unionByName(whole.filter("NOT stays").select(*KEY, "n"))
    rooms = [q - x for q, x in zip(quotas, loads(kept, len(quotas)))]
    order = running(cut.withColumn("everything", F.lit(0)), ["everything"], F.lit(0))
    placed = materialize(order.select(*KEY, "n", shard_at(rooms, F.col("upto") - F.col("n")).alias("shard"),
                                      shard_at(rooms, F.col("upto") - 1).alias("last")), "packed")
    inside = placed.filter("shard = last").select(*KEY, "shard", "n")
    rooms = [r - x for r, x in zip(rooms, loads(inside, len(quotas)))]
    across = settled(placed.filter("shard <> last").select(*KEY, "n"), rooms)  # fewer than shards
    return kept.unionByName(inside).unionByName(across)


def shards(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """(doc_id, row_key, size, text_crc32, shard, slot) for every row of ``docs``; slots count from 0 in each shard."""
    key = KEY
    rows = materialize(linked_rows(docs).withColumn("spread", F.xxhash64("row_key", F.lit("shard"))), "rows")
    quotas = quota(rows.count(), n_shards)
    sizes = materialize(rows.groupBy(*key).agg(F.count("*").alias("all")).filter("all > 1"), "sizes")
    is_big = F.col("all") * BIG > min(quotas)
    rooms = list(quotas)
    big = settled(sizes.filter(is_big).select(*key, F.col("all").alias("n")), rooms)
    start = shard_at(rooms, F.pmod(F.xxhash64("row_key", "doc_id", F.lit("start")), F.lit(max(1, sum(rooms)))))
    cells = materialize(rows.join(sizes.filter(~is_big), key, "left_semi").groupBy(*key, start.alias("shard"))
                        .agg(F.count("*").alias("n")), "cells")
    cells = materialize(packed(propagate(cells, rooms), rooms).unionByName(big), "cells")

    # parts of each key, as ranges of its documents' ranks; without a link: free
    parts = cells.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("parts"), F.sum("n").alias("placed"))
    parts = materialize(parts.join(sizes, key, "right").select(
        *key, F.when((F.size("parts") == 1) & (F.col("placed") == F.col("all")), F.get("parts", F.lit(0)).shard).alias("only"),
        F.coalesce("parts", F.expr("cast(array() as array<struct<shard:int,n:long>>)")).alias("parts")), "parts")
    with_parts = rows.join(parts, key, "left").withColumn("is_free", F.col("parts").isNull())
    base = ["doc_id", "row_key", "size", "text_crc32", "link", "spread"]
    one = with_parts.filter("only IS NOT NULL").select(*base, F.col("only").alias("shard"))
    split = ranked(with_parts.filter("only IS NULL AND NOT is_free"), key, ["row_key", "doc_id"], "at")
    ends = F.transform("parts", lambda p, i: F.struct(
        p.shard.alias("shard"),
        F.aggregate(F.slice("parts", 1, i + 1), F.lit(0).cast("long"), lambda a, q: a + q.n).alias("end")))
    split = split.select(*base, F.get(F.filter(ends, lambda e: e.end > F.col("at")), F.lit(0)).shard.alias("shard"))
    free = with_parts.filter("is_free").select(*base).unionByName(split.filter("shard IS NULL").select(*base))
    left = [q - x for q, x in zip(quotas, loads(cells, n_shards))]
    upto = longs([sum(left[:s + 1]) for s in range(n_shards)])
    filled = ranked(free.withColumn("everything", F.lit(0)), ["everything"], ["row_key", "doc_id"], "at").select(
        *base, F.size(F.filter(upto, lambda x: x <= F.col("at"))).alias("shard"))
    placed = materialize(one.unionByName(split.filter("shard IS NOT NULL")).unionByName(filled), "placed")
    return ranked(placed, ["shard"], ["row_key", "doc_id"], "slot").select(
        "doc_id", "row_key", "size", "text_crc32", F.col("shard").cast("int"), "slot")


def sharded_documents(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """``docs`` with the columns ``shard`` and ``slot`` (which replace columns of these names)."""
    placed = materialize(shards(docs, n_shards).select(F.col("row_key").alias("__row_key"), "shard", "slot"), "shards")
    repeated = materialize(placed.groupBy("__row_key").count().filter("count > 1").select("__row_key"), "repeated")
    return attach(docs.drop("shard", "slot"), placed, repeated)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: shard and slot of all documents, under the law ``rows``."""
    return shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
