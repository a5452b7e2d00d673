"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; neighbours of
the same role are merged into one block by array functions; blocks are rendered
and concatenated. Template of a block, in which only control strings hold ``<``::

    <turn>role<text>first text<part>second text</turn>\\n

Texts and roles are escaped reversibly: ``\\`` becomes ``\\b`` and ``<`` becomes
``\\l``, so no text can hold a control string, and a merged block keeps where its
turns met. ``loss_spans`` gives, for each text of a loss role, its start (from 0)
and length in code points of the formatted string, without any control string.

Defined results: a null role or text is empty; rows of equal (conversation, turn)
are ordered by role and then text, and repeated rows are kept as turns of their
own; a null turn comes first; a null conversation id is a conversation of its
own; an empty table gives an empty result; other columns are ignored. One
conversation is one output row, so its rendered text must fit into a Spark string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

TURN, TEXT, PART, END = "<turn>", "<text>", "<part>", "</turn>\n"
LOSS_ROLES = ("assistant",)
#: The control string test of the query: both turns of conversation -7 say this.
PROBE = "\\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def joined(parts: Column, by: str = "") -> Column:
    return F.array_join(parts, by)


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """(conv_id, formatted, loss_spans array<struct<start, chars>>), one row for each conversation."""
    clean = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        escape(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    sorted_ = clean.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    starts = sorted_.withColumn("starts", F.filter(
        F.sequence(F.lit(0), F.size("t") - 1),
        lambda i: (i == 0) | (F.get("t", i).role != F.get("t", i - 1).role)))
    blocks = starts.select("conv_id", F.transform("starts", lambda at, k: F.struct(
        F.get("t", at).role.alias("role"),
        F.transform(F.slice("t", at + 1, F.coalesce(F.get("starts", k + 1), F.size("t")) - at), lambda x: x.text)
        .alias("texts"))).alias("blocks"))
    #: Before each text: the control strings since the last one.
    segments = F.flatten(F.transform("blocks", lambda b, k: F.transform(b.texts, lambda x, j: F.struct(
        F.when(j > 0, F.lit(len(PART))).otherwise(
            F.when(k > 0, F.lit(len(END))).otherwise(F.lit(0)) + len(TURN) + F.length(escape(b.role)) + len(TEXT))
        .cast("long").alias("lead"),
        F.length(x).cast("long").alias("chars"), b.role.isin(*loss_roles).alias("loss")))))
    spans = F.aggregate(
        segments,
        F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:long,chars:long>>)").alias("spans")),
        lambda acc, s: F.struct(
            (acc.at + s.lead + s.chars).alias("at"),
            F.when(s.loss, F.concat(acc.spans, F.array(F.struct((acc.at + s.lead).alias("start"), s.chars.alias("chars")))))
            .otherwise(acc.spans).alias("spans")),
        lambda acc: acc.spans)
    rendered = joined(F.transform("blocks", lambda b: F.concat(
        F.lit(TURN), escape(b.role), F.lit(TEXT), joined(b.texts, PART), F.lit(END))))
    return blocks.select("conv_id", rendered.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns in a formatted string, as they were before merging and escaping."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = F.substring_index(F.substr(block, F.lit(len(TURN) + 1)), TEXT, 1)
        texts = F.split(F.substr(block, F.lit(len(TURN) + len(TEXT) + 1) + F.length(role)), PART)
        return F.transform(texts, lambda x: F.struct(unescape(role).alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between the texts."""
    return joined(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s.start + 1).cast("int"), s.chars.cast("int")))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: all conversations and the probe, read back from their formatted form."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    out = format_conversations(rows.unionByName(probe)).select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    line = F.lit("\n")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined(F.transform("turns", lambda t: F.concat(t.role, line, t.text, line))), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


SQL = """
WITH rows AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')
), marked AS (
  SELECT *, LAG(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS DISTINCT FROM role AS opens,
         length(text) + length(text) - length(replace(replace(text, '\\', ''), '<', '')) AS chars,
         length(role) + length(role) - length(replace(replace(role, '\\', ''), '<', '')) AS role_chars
  FROM rows
)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       SUM(chars + CASE WHEN opens THEN 20 + role_chars ELSE 6 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
