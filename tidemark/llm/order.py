"""Global order of a table without a window over all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

#: ``monotonically_increasing_id`` numbers the rows of a partition in its low 33 bits.
ROW_MASK = 2 ** 33 - 1


def placed(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` with ``place``, their dense number from 0 in the order of ``by`` (nulls first), and ``piece``.

    Rows are dealt by range and numbered inside their piece; a piece's offset comes from the counts of the
    pieces, which are as many as the shuffle has partitions, so that table is broadcast. Rows with equal keys
    are told apart by where they were read, so any number of them spreads over pieces. The table is written
    before its places are used: a lost executor cannot change them. ``rows`` must not have columns of these names.
    """
    dealt = (rows.withColumn("read_as", F.monotonically_increasing_id())
             .repartitionByRange(*by, "read_as").sortWithinPartitions(*by, "read_as").drop("read_as")
             .withColumn("piece", F.spark_partition_id())
             .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_MASK))))
    dealt = materialize(dealt, name)
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # one row for each piece
    offsets = dealt.groupBy("piece").count().select(
        "piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    return dealt.join(F.broadcast(offsets), "piece").withColumn("place", F.col("offset") + F.col("at")).drop("offset", "at")
