"""Generic, column-parameterised DataFrame operators.

The issue pipeline is one caller of these; the same functions run on the
driver's test tables, so every registered query exercises the operator itself.
Each operator is a declarative composition of built-in Spark operators so that
Catalyst can push filters and prune columns through it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


# --------------------------------------------------------------------------
# Keep-latest (upsert winner) per key
# --------------------------------------------------------------------------


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (ROW_NUMBER() = 1).

    Spark plans a partial ``WindowGroupLimit`` before the shuffle for this shape,
    so each map task forwards at most one row per key: a key with millions of
    versions does not pile its versions onto one reducer.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def union_by_declared_schema(frames: Sequence[DataFrame], schema) -> DataFrame:
    """UNION ALL BY NAME onto a declared schema.

    Missing columns become typed NULLs, extra columns are dropped and each
    column is ``try_cast`` to the declared type, so that a string time in an old
    file and a timestamp in a new file meet as timestamps.
    """
    aligned = [conform(f, schema) for f in frames]
    out = aligned[0]
    for f in aligned[1:]:
        out = out.unionByName(f)
    return out


def conform(df: DataFrame, schema) -> DataFrame:
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for field in schema.fields:
        if field.name not in have:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif have[field.name] == field.dataType:
            cols.append(F.col(field.name))
        else:
            cols.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
    return df.select(*cols)


# --------------------------------------------------------------------------
# Dense daily series
# --------------------------------------------------------------------------


def daily_event_counts(
    df: DataFrame,
    keys: Sequence[str],
    events: dict[str, Column],
    date_col: str = "calendar_date",
) -> DataFrame:
    """Count several dated event kinds per ``keys`` and day in ONE aggregation.

    ``events`` maps an output count column to a DATE expression (NULL = no
    event). Each input row is fanned out to its events with ``explode``, so the
    table is scanned once and shuffled once, with map-side partial counts;
    a hot key only adds rows to its (key, day) partial sums.
    """
    kinds = list(events)
    tagged = F.array(*[F.struct(F.lit(i).alias("k"), e.alias("d")) for i, e in enumerate(events.values())])
    exploded = (
        df.select(*_cols(keys), F.explode(tagged).alias("_e"))
        .filter(F.col("_e.d").isNotNull())
        .select(*_cols(keys), F.col("_e.k").alias("_k"), F.col("_e.d").alias(date_col))
    )
    aggs = [F.count_if(F.col("_k") == i).cast("bigint").alias(name) for i, name in enumerate(kinds)]
    return exploded.groupBy(*keys, date_col).agg(*aggs)


def date_spine(daily: DataFrame, keys: Sequence[str], date_col: str = "calendar_date") -> DataFrame:
    """Every day between each key's first and last day, inclusive."""
    bounds = daily.groupBy(*keys).agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    return bounds.select(
        *_cols(keys), F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(date_col)
    )


def densify(
    daily: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    date_col: str = "calendar_date",
) -> DataFrame:
    """Fill each key's gaps between its first and last day with zero rows.

    One window pass instead of spine + self-join: every sparse day looks at
    the key's next day (``lead``) and emits itself plus the empty days up to
    it. The input is read once (a self-join would evaluate it twice), and
    the window is partitioned by key over days, so even the hottest key is
    one row per day. The window's partitioning is reused by any later
    window on the same key.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(date_col)
    with_next = daily.select(*_cols(keys), F.col(date_col), *_cols(measures), F.lead(date_col).over(w).alias("_next"))
    last = F.coalesce(F.date_sub("_next", 1), F.col(date_col))
    days = F.sequence(F.col(date_col), last, F.expr("INTERVAL 1 DAY"))
    filled = with_next.select(*_cols(keys), F.col(date_col), *_cols(measures), F.posexplode(days).alias("_pos", "_d"))
    return filled.select(
        *_cols(keys),
        F.col("_d").alias(date_col),
        *[
            F.when(F.col("_pos") == 0, F.coalesce(F.col(m), F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias(m)
            for m in measures
        ],
    )


def running_and_rolling(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    running: dict[str, str],
    rolling: dict[str, str],
    rows: int = 7,
) -> DataFrame:
    """Running totals and trailing ``rows``-row sums per key, in one window spec.

    On a dense daily spine a 7-row frame is a true 7-day window. Partitions are
    per key and hold one row per day, so even the largest key is small.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(order_col)
    run_w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    roll_w = w.rowsBetween(-(rows - 1), Window.currentRow)
    cols = [F.sum(src).over(run_w).cast("bigint").alias(out) for out, src in running.items()]
    cols += [F.sum(src).over(roll_w).cast("bigint").alias(out) for out, src in rolling.items()]
    return df.select("*", *cols)


# --------------------------------------------------------------------------
# Ranking, top-k
# --------------------------------------------------------------------------


def rank_within(df: DataFrame, keys: Sequence[str], ranks: dict[str, Column]) -> DataFrame:
    """Add ``RANK()`` columns (ties share a rank) per ``keys``; ``ranks`` maps name -> order."""
    out = df
    for name, order in ranks.items():
        w = Window.partitionBy(*_cols(keys)).orderBy(order)
        out = out.withColumn(name, F.rank().over(w).cast("bigint"))
    return out


#: Reducers that share a hot group's winners before they meet.
TOP_K_PARTS = 32


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, parts: int = TOP_K_PARTS) -> DataFrame:
    """At most ``k`` rows per group under a total order (add a tie key to ``order``), sorted by group and ``order``.

    Two stages: the map tasks, whose partial ``WindowGroupLimit`` leaves ``k`` rows of a group each, are dealt to
    ``parts`` reducers by their partition number; these leave ``k`` rows each, so the group's last reducer reads
    ``parts * k`` rows however many tasks hold the group. The total order makes the result independent of the dealing.
    """
    dealt = df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(parts)))
    for by in (["_part"], []):
        w = Window.partitionBy(*_cols([*keys, *by])).orderBy(*order)
        dealt = dealt.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    return dealt.drop("_rn", "_part").orderBy(*_cols(keys), *order)


# --------------------------------------------------------------------------
# Per-key lists
# --------------------------------------------------------------------------


def sorted_lists(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """One row per key with the ascending list of ``value`` (NULLs kept, last)."""
    from tidemark.functions import sorted_list

    return df.groupBy(*keys).agg(sorted_list(value).alias(out))


# --------------------------------------------------------------------------
# Integrity checks (each returns violating rows or groups; count() them)
# --------------------------------------------------------------------------


def duplicate_key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def orphan_rows(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows with no parent on ``keys`` (NOT EXISTS, planned as an anti-join)."""
    return child.join(parent.select(*keys), list(keys), "left_anti")


def spine_gap_groups(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """Groups with another number of rows than days from first to last: (keys, missing_days, repeated_days).

    Both are counted from each row to the group's next one."""
    day = F.col(date_col).cast("date")
    following = F.lead(day).over(Window.partitionBy(*_cols(keys)).orderBy(day))
    skipped = F.greatest(F.datediff(following, day) - 1, F.lit(0))
    repeated = F.coalesce(F.datediff(following, day) == 0, F.lit(False))
    steps = df.select(*_cols(keys), skipped.alias("skipped"), repeated.alias("repeated"))
    return steps.groupBy(*keys).agg(
        F.coalesce(F.sum("skipped"), F.lit(0)).cast("bigint").alias("missing_days"),
        F.count_if("repeated").alias("repeated_days")).filter("missing_days <> repeated_days")
