"""Merkle manifest of a dataset by lag and lead windows.

Every row is a leaf. Per source, leaves stand in the order of their ids; on each
level runs of ``FAN`` neighbours become one parent, until one node, the subroot,
is left. Subroots, in the order of their sources, make the root in the same way.

A level is one window pass: lag and lead columns with the fixed offsets 1 to
``FAN - 1`` hold a node's neighbours, and a mask by slot (place in the run) and run
length leaves its siblings. The rows of the first children have all siblings on
their right and hash the parents. Windows are cut into blocks of ``BLOCK`` nodes, a
multiple of ``FAN``, so that no run is cut and a source of any size spreads over
tasks. Each level is written once; a proof goes down the levels by a join of
children with their parent, so no join key is hotter than a run. The proofs of a level
are written too, so that no plan holds more than one level, however high the tree.

Defined results: null fields are written ``-``; a null source is a source of its
own, the first; null ids come first, equal ids are ordered by their leaves, and
repeated rows are leaves of their own; a source of one row has its leaf as subroot;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, table
from tidemark.llm.order import placed

FAN = 3
#: Nodes of one window partition: a multiple of ``FAN``.
BLOCK = FAN ** 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts' concatenation."""
    return F.sha2(F.concat(*parts), 256)


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def written(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    return sha(*[written(v) for v in values])


def with_siblings(nodes: DataFrame, fan: int = FAN, block: int = BLOCK) -> DataFrame:
    """``nodes`` (g, pos, n, digest, ...) with ``left`` and ``right``: the siblings' digests on either side, joined."""
    window = Window.partitionBy("g", F.expr(f"pos div {block}")).orderBy("pos")
    slot = F.col("pos") % fan
    run = F.least(F.lit(fan), F.col("n") - (F.col("pos") - slot))
    none = F.unhex(F.lit(""))
    left = [F.when(slot >= k, F.lag("digest", k).over(window)).otherwise(none) for k in range(fan - 1, 0, -1)]
    right = [F.when(slot + k < run, F.lead("digest", k).over(window)).otherwise(none) for k in range(1, fan)]
    return nodes.select("*", F.concat(*left).alias("left"), F.concat(*right).alias("right"))


def parents(level: DataFrame, fan: int = FAN) -> DataFrame:
    """The next level's nodes, hashed by the rows of the first children; sources that are down to one node end here."""
    first = level.filter((F.col("n") > 1) & (F.col("pos") % fan == 0))
    return first.select("g", F.expr(f"pos div {fan}").alias("pos"), F.expr(f"(n + {fan - 1}) div {fan}").alias("n"),
                        F.unhex(sha(hexed(F.col("digest")), hexed(F.col("right")))).alias("digest"))


def climb(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """All levels over ``nodes``, leaves first, each written with its siblings; ``most`` is the largest ``n``."""
    levels = [materialize(with_siblings(nodes), f"{name}-0")]
    while most > 1:
        most = -(-most // FAN)
        levels.append(materialize(with_siblings(parents(levels[-1])), f"{name}-{len(levels)}"))
    return levels


def tips(levels: list[DataFrame]) -> DataFrame:
    """(g, level, digest) of the node that is left of each group."""
    return reduce(DataFrame.union, [
        level.filter("n = 1").select("g", F.lit(k).alias("level"), "digest") for k, level in enumerate(levels)])


def descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves' level with ``top`` and ``proof``: array<struct<left, right>> from the leaf's run to the top.

    ``tops`` (g, level, top, proof): where each group ended, and the proof from there on.
    """
    above: DataFrame | None = None
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k] if k == 0 else levels[k].select("g", "pos", "n", "left", "right")
        kept = [c for c in level.columns if c not in ("n", "left", "right")]
        over = tops.filter(F.col("level") == k).select("g", F.lit(0).cast("long").alias("up"), "top", F.col("proof").alias("rest"))
        if above is not None:
            over = over.union(above.select("g", F.col("pos").alias("up"), "top", F.col("proof").alias("rest")))
        step = F.array(F.struct("left", "right"))
        proof = F.when(F.col("n") > 1, F.concat(step, "rest")).otherwise(F.col("rest"))
        above = level.withColumn("up", F.expr(f"pos div {FAN}")).join(over, ["g", "up"]).select(*kept, "top", proof.alias("proof"))
        if k > 0:
            above = materialize(above, "proofs")
    return above


def manifest(leaves: DataFrame) -> tuple[DataFrame, str | None]:
    """Proofs of ``leaves`` (id, source, leaf binary, and other columns) and the root in hex (None for no leaf).

    The result has all columns of ``leaves`` with ``digest`` for ``leaf``, ``subroot`` and ``proof``.
    """
    more = [c for c in leaves.columns if c not in ("id", "source", "leaf")]
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key")
    dealt = placed(leaves.select(key, "id", F.col("leaf").alias("digest"), *more), ["key", "id", "digest"], "leaves")
    parts = dealt.groupBy("key", "piece").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    sources = placed(parts.groupBy("key").agg(F.min("first").alias("start"), F.sum("rows").alias("n")), ["key"], "sources")
    total = sources.agg(F.count("*"), F.max("n")).first()
    starts = parts.select("key", "piece").join(sources.select("key", F.col("place").alias("g"), "start", "n"), "key")
    nodes = dealt.join(starts, ["key", "piece"]).select("g", (F.col("place") - F.col("start")).alias("pos"), "n", "digest", "id", *more)
    levels = climb(nodes, total[1] or 0, "manifest")
    subroots = materialize(tips(levels), "subroots")
    upper = climb(subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"),
                                  F.lit(total[0]).cast("long").alias("n"), "digest",
                                  F.col("g").alias("source"), F.col("level").alias("ended")), total[0], "manifest-sources")
    root = tips(upper).first()
    end = F.expr("cast(array() as array<struct<left: binary, right: binary>>)")
    tops = descend(upper, tips(upper).select("g", "level", F.col("digest").alias("top"), end.alias("proof"))) \
        .select(F.col("source").alias("g"), F.col("ended").alias("level"), F.col("digest").alias("top"), "proof")
    out = descend(levels, materialize(tops, "source-proofs"))
    return out.drop("g", "pos").withColumnRenamed("top", "subroot"), root and bytes(root["digest"]).hex()


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf (hex) and its siblings give."""
    return F.aggregate(proof, leaf, lambda node, run: sha(hexed(run.left), node, hexed(run.right)))


def proof_digest(proof: Column) -> Column:
    """One hash of all siblings of a proof, in order."""
    return F.sha2(F.array_join(F.transform(proof, lambda run: hexed(F.concat(run.left, run.right))), ""), 256)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the manifest of all documents, and the roots that tampered texts fold to."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    values = [F.col(c) for c in FIELDS]
    changed = leaf_of(*values[:-1], F.replace("text", F.lit("\n"), F.lit("")))
    leaves = docs.select(F.col("doc_id").alias("id"), "source", F.unhex(leaf_of(*values)).alias("leaf"),
                         F.when(tampered, F.unhex(changed)).alias("changed"))
    proofs, root = manifest(leaves)
    root_text = F.lit(root).cast("string")
    out = proofs.select(
        F.col("id").alias("doc_id"), hexed(F.col("digest")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
        root_text.alias("root"), proof_digest(F.col("proof")).alias("proof_sha256"),
        fold(hexed(F.coalesce("changed", "digest")), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


SQL = """
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, text, sha256(a || b) AS leaf,
         CASE WHEN crc & 1 = 1 THEN sha256(a || b)
              ELSE sha256(a || COALESCE(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS shown
  FROM (SELECT *, COALESCE(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || COALESCE(strlen(source) || ':' || source, '-')
                  || COALESCE(strlen(lang) || ':' || lang, '-') || COALESCE(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS a,
               COALESCE(strlen(text) || ':' || text, '-') AS b,
               COALESCE(xor(4294967295, list_reduce(
                 list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                 lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))), 1) AS crc
        FROM documents) AS written
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g
  FROM leaves
), tree AS (  -- every node of every source
  SELECT 0 AS level, g, pos, leaf AS digest, COUNT(*) OVER (PARTITION BY g) AS n FROM numbered
  UNION ALL
  SELECT level, g, pos, sha256(digest), (n + 2) // 3 FROM (
    SELECT level + 1 AS level, g, pos // 3 AS pos, string_agg(digest, '' ORDER BY pos) AS digest, MIN(n) AS n
    FROM tree WHERE n > 1 GROUP BY level + 1, g, pos // 3) AS runs
), subroots AS (
  SELECT g, digest AS subroot, level AS height FROM tree WHERE n = 1
), upper AS (
  SELECT 0 AS level, g AS pos, subroot AS digest, COUNT(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level, pos, sha256(digest), (n + 2) // 3 FROM (
    SELECT level + 1 AS level, pos // 3 AS pos, string_agg(digest, '' ORDER BY pos) AS digest, MIN(n) AS n
    FROM upper WHERE n > 1 GROUP BY level + 1, pos // 3) AS runs
), nodes AS (
  SELECT level, g, pos, digest FROM tree WHERE n > 1
), upper_nodes AS (
  SELECT level, pos, digest FROM upper WHERE n > 1
), path AS (  -- a leaf's way to the root, one step a level
  SELECT doc_id, leaf, g, pos AS own, 0 AS step, shown AS node, '' AS proof FROM numbered
  UNION ALL
  SELECT doc_id, leaf, g, own, step + 1, sha256(before || node || after), proof || before || after
  FROM (
    SELECT p.doc_id, p.leaf, p.g, p.own, p.step, p.node, p.proof,
           COALESCE(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < s.mine), '') AS before,
           COALESCE(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > s.mine), '') AS after
    FROM (SELECT path.*, height FROM path JOIN subroots USING (g)) AS p
    JOIN (
      SELECT numbered.g, numbered.pos AS own, level AS step, nodes.pos, numbered.pos // (3 ** level)::BIGINT AS mine, digest
      FROM numbered JOIN nodes ON nodes.g = numbered.g AND nodes.pos // 3 = numbered.pos // (3 ** (level + 1))::BIGINT
      UNION ALL
      SELECT numbered.g, numbered.pos, height + level, upper_nodes.pos, g // (3 ** level)::BIGINT, digest
      FROM numbered JOIN subroots USING (g)
      JOIN upper_nodes ON upper_nodes.pos // 3 = g // (3 ** (level + 1))::BIGINT
    ) AS s ON s.g = p.g AND s.own = p.own AND s.step = p.step
    GROUP BY p.doc_id, p.leaf, p.g, p.own, p.step, p.node, p.proof) AS joined
), ends AS (
  SELECT *, row_number() OVER (PARTITION BY g, own ORDER BY step DESC) AS last FROM path
)
SELECT doc_id, leaf, subroot, (SELECT digest FROM upper WHERE n = 1) AS root, sha256(proof) AS proof_sha256,
       node AS folded_root, node = (SELECT digest FROM upper WHERE n = 1) AS verified
FROM ends JOIN subroots USING (g) WHERE last = 1
"""
