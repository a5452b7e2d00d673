"""Conversation repair by weighted CYK parsing of spans.

The rows of a conversation are words of a repair grammar whose sentences are the
role sequences ``(s?(ua)+)?`` (system once, then user and assistant in turn). Four
states tell what was said so far: 0 nothing, S system, U user, A assistant. The
grammar's symbols are the pairs (p, q) of states: a span derives (p, q) if its
edits lead from p to q. In Chomsky normal form:

* a row derives (p, q) by Keep (its own role, cost 0), Rerole (user or assistant, 2)
  or Delete (p = q, 3); blank and duplicate rows only by Delete, and an undeleted
  truncated row adds 1;
* Insert (user or assistant, 2) derives from the empty span, so its closure (no, one or
  two insertions between any two states) is multiplied onto both sides of each row;
* (p, q) -> (p, r) (r, q).

A cell holds, for each symbol, the least (cost, audit) of a span, and spans are
combined bottom-up by their length, over all their splits. The audit fixes the
cost, and of a span's audits with one cost none begins another, so the least part
always makes the least whole: cells need only one entry.

A conversation of any length is cut into blocks of ``BLOCK`` rows in the global order
of rows; equal blocks are parsed once; the cells of blocks are then the words of
the next round, until each conversation is one span. Only its audit, which is part
of the result, grows with the conversation. The digest of the repaired rows needs
them in order: one task reads a conversation's sorted rows as a stream, batch by
batch, and holds none of them.

Defined results: null roles and texts are one space; rows of equal turns are ordered
by role and text, null turns first; a null conversation id is a conversation of its
own; role initials are a role's first character; a conversation without rows has
zeros, an empty audit and the hash of nothing; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, table
from tidemark.llm.order import placed

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Rows, or cells, that one CYK table spans.
BLOCK = 16
SPACES = " \t\n\x0b\x0c\r"
#: What a role's initial leads to from each state.
MOVES = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
STATES = "0SUA"
ACCEPTED = ("00", "0A")
#: Cheapest insertions between states: the closure of Insert.
CLOSURE = {"00": "", "SS": "", "UU": "", "AA": "", "0U": "I", "0A": "II", "SU": "I", "SA": "II", "UA": "I", "AU": "I"}
SYMBOLS = (*CLOSURE, "0S")
#: (symbol, left symbol, right symbol) as places in ``SYMBOLS``.
RULES = [(SYMBOLS.index(p + q), SYMBOLS.index(p + r), SYMBOLS.index(r + q))
         for p in STATES for q in STATES for r in STATES if p + q in SYMBOLS and p + r in SYMBOLS and r + q in SYMBOLS]

Cell = list[tuple[int, str] | None]


def joined(left: Cell, right: Cell, best: Cell) -> Cell:
    """``best`` or what the rules make of two neighbouring spans, symbol by symbol."""
    for symbol, a, b in RULES:
        x, y = left[a], right[b]
        if x is None or y is None:
            continue
        now, cost = best[symbol], x[0] + y[0]
        if now is None or cost < now[0]:
            best[symbol] = (cost, x[1] + y[1])
        elif cost == now[0]:
            audit = x[1] + y[1]
            if audit < now[1]:
                best[symbol] = (cost, audit)
    return best


def nothing() -> Cell:
    return [None] * len(SYMBOLS)


EMPTY: Cell = [(INSERT * len(CLOSURE[s]), CLOSURE[s]) if s in CLOSURE else None for s in SYMBOLS]


def row_cell(code: str) -> Cell:
    """The cell of one row: its initial (upper case if truncated; other roles ``x``), or ``-`` if it must go."""
    own = nothing()
    more = TRUNCATED if code.isupper() else 0
    for at, symbol in enumerate(SYMBOLS):
        p, q = symbol
        edits = [(DELETE, "D")] if p == q else []
        if code != "-":
            if MOVES.get((p, code.lower())) == q:
                edits.append((KEEP + more, "K"))
            if q in (MOVES.get((p, "u")), MOVES.get((p, "a"))):
                edits.append((REROLE + more, "R"))
        own[at] = min(edits, default=None)
    return joined(joined(EMPTY, own, nothing()), EMPTY, nothing())


ROWS = {code: row_cell(code) for code in "suaxSUAX-"}


def parse(words: list[Cell]) -> Cell:
    """The cell of all ``words`` (at least one): spans by length, each over all its splits."""
    spans = {(i, i + 1): word for i, word in enumerate(words)}
    for length in range(2, len(words) + 1):
        for i in range(len(words) - length + 1):
            cell = nothing()
            for k in range(i + 1, i + length):
                joined(spans[i, k], spans[k, i + length], cell)
            spans[i, i + length] = cell
    return spans[0, len(words)]


CELL_TYPE = "costs array<int>, audits array<string>"


def cells_out(keys: list[pa.Array], names: list[str], cells: Iterable[Cell]) -> pa.RecordBatch:
    cells = list(cells)
    return pa.RecordBatch.from_arrays(
        [*keys, pa.array([[x and x[0] for x in c] for c in cells], pa.list_(pa.int32())),
         pa.array([[x and x[1] for x in c] for c in cells], pa.list_(pa.string()))], names=[*names, "costs", "audits"])


def parse_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(codes) -> (codes, cell)."""
    for batch in batches:
        yield cells_out([batch.column(0)], ["codes"], (parse([ROWS[c] for c in codes]) for codes in batch.column(0).to_pylist()))


def parse_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, block, spans: their cells in order) -> (key, block, cell)."""
    for batch in batches:
        words = ([[None if c is None else (c, a) for c, a in zip(s["costs"], s["audits"])] for s in spans]
                 for spans in batch.column(2).to_pylist())
        yield cells_out([batch.column(0), batch.column(1)], ["key", "block"], map(parse, words))


def expand_audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, audit) -> (key, number, edit, role, before, after): a row for each row of the conversation.

    ``role`` is a rerole's new role; ``before`` holds the lines inserted before the row, ``after`` those behind the last.
    """
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for key, audit in zip(*(c.to_pylist() for c in batch.columns)):
            said = len(audit) - audit.count("D")
            turn = said % 2  # an odd number of turns starts with the system's
            count = 0

            def role() -> str:
                return "user" if (count - turn) % 2 == 0 else "assistant"

            steps = re.findall("I*[KRD]", audit)
            tail = len(audit) - sum(map(len, steps))
            for number, step in enumerate(steps):
                before = []
                for _ in step[:-1]:
                    before.append(role() + ":")
                    count += 1
                edit, new = step[-1], role() if step[-1] == "R" else None
                count += edit != "D"
                after = []
                for _ in range(tail if number == len(steps) - 1 else 0):
                    after.append(role() + ":")
                    count += 1
                for column, value in zip(out, (key, number, edit, new, "\n".join(before) or None, "\n".join(after) or None)):
                    column.append(value)
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                         names=["key", "number", "edit", "role", "before", "after"])


def hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, line) that stand together by key -> (key, sha256 of the lines that are not null, joined by newlines)."""
    def done(keys: list[str], digests: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(digests, pa.string())], names=["key", "sha"])

    at, digest, lines = None, hashlib.sha256(), 0
    for batch in batches:
        keys, digests = [], []
        for key, line in zip(*(c.to_pylist() for c in batch.columns)):
            if key != at:
                if at is not None:
                    keys.append(at)
                    digests.append(digest.hexdigest())
                at, digest, lines = key, hashlib.sha256(), 0
            if line is not None:
                digest.update(("\n" if lines else "").encode() + line.encode())
                lines += 1
        yield done(keys, digests)
    if at is not None:
        yield done([at], [digest.hexdigest()])


def conversation_key(conv: Column) -> Column:
    """A text that is never null: joins and groups by it keep null conversations."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def faulty(rows: DataFrame) -> DataFrame:
    """``rows`` (key, turn, role, text) in global order (``place``) with their initial and first fault."""
    bare = F.rtrim("text", F.lit(SPACES))
    marked = rows.select("key", "turn", "role", "text", F.sha2("text", 256).alias("digest"), F.substring("role", 1, 1).alias("initial"),
                         (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"))
    ordered = placed(marked, ["key", "turn", "role", "text"], "turns").drop("piece")
    firsts = ordered.groupBy("key", "role", "digest").agg(F.min("place").alias("first"), F.count("*").alias("copies")) \
        .filter("copies > 1").drop("copies")
    seen = ordered.select("key", "role", "digest", "place").join(firsts, ["key", "role", "digest"]).filter("place > first") \
        .select("key", "place", F.lit(True).alias("duplicate"))
    duplicate = ~F.col("blank") & F.coalesce("duplicate", F.lit(False))
    return ordered.drop("digest").join(seen, ["key", "place"], "left").select(
        "key", "place", "turn", "role", "text", "initial", "blank", duplicate.alias("duplicate"),
        (F.col("truncated") & ~F.col("blank") & ~duplicate).alias("truncated"))


def spans_of(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, block, codes, illegal, first, last) of the blocks of rows."""
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    code = F.when(F.col("blank") | F.col("duplicate"), "-").when(F.col("truncated"), F.upper(initial)).otherwise(initial)
    return rows.groupBy("key", F.expr(f"place div {block}").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("place", code.alias("code"), initial.alias("initial")))).alias("rows")) \
        .select("key", "block", F.array_join("rows.code", "").alias("codes"), F.array_join("rows.initial", "").alias("initials"))


def illegal_pairs(initials: Column) -> Column:
    """Neighbours in a text of initials that are not su, ua or au."""
    return F.size(F.filter(F.sequence(F.lit(1), F.length(initials)),
                           lambda k: (k < F.length(initials)) & ~F.substr(initials, k, F.lit(2)).isin("su", "ua", "au"))).cast("long")


def parsed(spans: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, cost, audit, illegal) of every conversation in ``spans``."""
    spans = materialize(spans, "spans")
    cells = materialize(spans.select("codes").distinct().mapInArrow(parse_codes, "codes string, " + CELL_TYPE), "cells")
    at = spans.join(cells, "codes").select(
        "key", "block", illegal_pairs(F.col("initials")).alias("illegal"), F.substring("initials", 1, 1).alias("first"),
        F.substring("initials", -1, 1).alias("last"), "costs", "audits")
    done = []
    while True:
        alone = at.groupBy("key").agg((F.count("*") == 1).alias("alone"), F.min("block").alias("start"))
        at = materialize(at.join(alone, "key"), "spans")
        done.append(at.filter("alone"))
        if at.filter("NOT alone").isEmpty():
            break
        grouped = at.filter("NOT alone").groupBy("key", F.expr(f"(block - start) div {block}").alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("block", "illegal", "first", "last", "costs", "audits"))).alias("spans"))
        grouped = materialize(grouped, "span-groups")
        cells = grouped.select("key", "block", "spans").mapInArrow(parse_cells, "key string, block long, " + CELL_TYPE)
        ends = grouped.select(
            "key", "block", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.illegal).alias("inside"),
            illegal_between(F.col("spans")).alias("between"), F.get(F.col("spans"), F.lit(0))["first"].alias("first"),
            F.element_at("spans", -1)["last"].alias("last"))
        at = cells.join(ends, ["key", "block"]).select(
            "key", "block", (F.col("inside") + F.col("between")).alias("illegal"), "first", "last", "costs", "audits")
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    best = F.array_min(F.array(*[F.struct(F.get("costs", F.lit(k)).alias("cost"), F.get("audits", F.lit(k)).alias("audit"))
                                 for k in (SYMBOLS.index(s) for s in ACCEPTED)]))
    return out.select("key", best["cost"].cast("long").alias("cost"), best["audit"].alias("audit"), "illegal")


def illegal_between(spans: Column) -> Column:
    """Illegal pairs where neighbouring spans meet."""
    return F.size(F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda k: (k > 0) & ~F.concat(
        F.get(spans, k - 1)["last"], F.get(spans, k)["first"]).isin("su", "ua", "au"))).cast("long")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repair of ``rows`` (key, turn, role, text): (conversations, lines).

    Conversations: key, the counts of their faults, gaps, illegal pairs, cost and audit. Lines: key, place, edit
    and ``line``, the repaired rows ``role:text`` that stand for the row, insertions included, null for none.
    """
    rows = materialize(faulty(rows), "faulty")
    by_turn = rows.groupBy("key", "turn").agg(*[F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")],
                                              F.min("place").alias("start"))
    counts = by_turn.groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.min("start").alias("start"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    done = materialize(parsed(spans_of(rows)).join(counts, "key"), "parsed")
    edits = done.select("key", "audit").mapInArrow(
        expand_audits, "key string, number long, edit string, role string, before string, after string")
    edits = edits.join(done.select("key", "start"), "key").select(
        "key", (F.col("start") + F.col("number")).alias("place"), "edit", F.col("role").alias("new_role"), "before", "after")
    # dealt by conversation once: the digest's stream reads this very partitioning
    deal = rows.select("key", "place", "role", "text").repartition("key").join(edits.repartition("key"), ["key", "place"])
    own = F.when(F.col("edit") != "D", F.concat(F.coalesce("new_role", "role"), F.lit(":"), "text"))
    line = F.when(own.isNotNull() | F.col("before").isNotNull() | F.col("after").isNotNull(), F.concat_ws("\n", "before", own, "after"))
    return done.drop("start"), deal.select("key", "place", "edit", line.alias("line"))


def digests(lines: DataFrame) -> DataFrame:
    """(key, sha) of the lines of each conversation in their order."""
    return lines.repartition("key").sortWithinPartitions("key", "place").select("key", "line").mapInArrow(
        hash_lines, "key string, sha string")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) as (key, turn, role, text) with the query's damage."""
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.select(conversation_key(F.col("conv_id")).alias("key"), "turn", F.coalesce("role", space).alias("role"),
                       F.coalesce("text", space).alias("text"), (F.crc32(named) % 20).alias("how")).filter("how <> 0")
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("how") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("key", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: all conversations, damaged and repaired."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    all_ = rows.select("conv_id").distinct().withColumn("key", conversation_key(F.col("conv_id")))
    done, lines = repair(damaged(rows))
    out = all_.join(done, "key", "left").join(digests(lines), "key", "left")
    zero = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in zero],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


SQL = """
WITH RECURSIVE crc AS (
  SELECT *, xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(COALESCE(conv_id::VARCHAR, ' ') || ':' || COALESCE(turn::VARCHAR, ' '), ''),
                                                       lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 20 AS how
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE COALESCE(role, ' ') END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(COALESCE(text, ' '), '[.!?]', '', 'g') ELSE COALESCE(text, ' ') END AS text
  FROM crc, LATERAL (SELECT unnest(CASE how WHEN 0 THEN []::INT[] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy) AS copies
), numbered AS (
  SELECT *, row_number() OVER all_rows AS pos, left(role, 1) AS initial, lag(left(role, 1)) OVER all_rows AS before, rtrim(text, E' \\t\\n\\x0B\\f\\r') AS bare
  FROM damaged WINDOW all_rows AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated'
                 ELSE '' END AS fault
  FROM numbered
), counts AS (
  SELECT conv_id, COUNT(*) AS rows, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps,
         COUNT(*) FILTER (fault = 'blank') AS blank, COUNT(*) FILTER (fault = 'duplicate') AS duplicate,
         COUNT(*) FILTER (fault = 'truncated') AS truncated,
         COUNT(*) FILTER (pos > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), steps AS (  -- the least edits of the first rows that lead to each state: nothing, system, user or assistant said last
  SELECT conv_id, 0::BIGINT AS pos, {'c': 0, 'a': '', 't': ''} AS z, {'c': 1000000000, 'a': '', 't': ''} AS s,
         {'c': 2, 'a': 'I', 't': chr(10) || 'user:'} AS u,
         {'c': 4, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS a
  FROM counts
  UNION ALL
  SELECT conv_id, pos, z, s, u, list_min([a, {'c': u.c + 2, 'a': u.a || 'I', 't': u.t || chr(10) || 'assistant:'}])
  FROM (
    SELECT conv_id, pos, z, s, a, list_min([u] || list_transform([z, s, a],
           lambda x: {'c': x.c + 2, 'a': x.a || 'I', 't': x.t || chr(10) || 'user:'})) AS u
    FROM (
      SELECT conv_id, pos, gone.z AS z, list_min([gone.s] || CASE WHEN stays AND initial = 's'
               THEN [{'c': z.c + more, 'a': z.a || 'K', 't': z.t || said}] ELSE [] END) AS s,
             list_min([gone.u] || CASE WHEN NOT stays THEN [] ELSE list_transform([z, s, a],
               lambda x: CASE WHEN initial = 'u' THEN {'c': x.c + more, 'a': x.a || 'K', 't': x.t || said}
                              ELSE {'c': x.c + more + 2, 'a': x.a || 'R', 't': x.t || chr(10) || 'user:' || text} END) END) AS u,
             list_min([gone.a] || CASE WHEN NOT stays THEN [] WHEN initial = 'a' THEN [{'c': u.c + more, 'a': u.a || 'K', 't': u.t || said}]
               ELSE [{'c': u.c + more + 2, 'a': u.a || 'R', 't': u.t || chr(10) || 'assistant:' || text}] END) AS a
      FROM (
        SELECT steps.conv_id, judged.pos, z, s, u, a, initial, text, chr(10) || role || ':' || text AS said,
               fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS more,
               {'z': {'c': z.c + 3, 'a': z.a || 'D', 't': z.t}, 's': {'c': s.c + 3, 'a': s.a || 'D', 't': s.t},
                'u': {'c': u.c + 3, 'a': u.a || 'D', 't': u.t}, 'a': {'c': a.c + 3, 'a': a.a || 'D', 't': a.t}} AS gone
        FROM steps JOIN judged ON judged.conv_id IS NOT DISTINCT FROM steps.conv_id AND judged.pos = steps.pos + 1) AS row_
    ) AS said) AS inserted
), best AS (
  SELECT steps.conv_id, list_min([z, a]) AS x FROM steps JOIN counts ON counts.conv_id IS NOT DISTINCT FROM steps.conv_id AND pos = rows
)
SELECT ids.conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
       COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, COALESCE(x.c, 0)::BIGINT AS cost, COALESCE(x.a, '') AS audit,
       sha256(COALESCE(x.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS ids
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
