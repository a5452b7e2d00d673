"""Structured Streaming variants of the incremental operators.

I10 - micro-batch upsert: each micro-batch of new records (or of new manifest
      rows, which name the runs to merge) is merged into a versioned snapshot
      with the same keep-latest rule as the batch pipeline. The merge is
      idempotent, so a micro-batch replayed after a failure is harmless.
I11 - daily counts as a stream: each micro-batch appends its partial counts
      per key and UTC day, and their sums are the current counts. There is no
      state and no watermark, so late rows count too.

Checkpoints and sink tables live under the session's shared checkpoint folder
(``spark.checkpoint.dir``), never on a machine-local path on a cluster.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import operators as ops
from tidemark.schemas import REPO_KEYS
from tidemark.session import checkpoint_dir, configure
from tidemark.sources import storage

COMMITS = "batch_id long, committed_at timestamp, is_base boolean"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


# --------------------------------------------------------------------------
# Micro-batch upsert into a versioned snapshot
# --------------------------------------------------------------------------


class SnapshotSink:
    """foreachBatch target: the winners of each micro-batch, folded into a base from time to time.

    Layout: ``<path>/data/batch=<id>/`` holds the latest row per key of a batch, ``<path>/base/covered=<id>/`` of all
    batches up to one; ``<path>/commits`` is an append-only log of finished batches and bases. Readers keep the latest
    row per key of the newest base and the committed batches after it. A batch is read once and nothing of the history
    is read for it; every ``fold`` batches the base and the batches after it become the next base, so a reader meets
    less than ``fold`` batches, however many there were. A replayed batch that is committed is left alone; a crash
    before the commit leaves nothing visible.
    """

    def __init__(self, path: str, keys: Sequence[str], order: Sequence[str], fold: int = 20):
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.order = list(order)
        self.fold = fold

    def _order(self) -> list[Column]:
        return [F.col(c).desc_nulls_last() for c in self.order]

    def _commits(self, spark: SparkSession) -> DataFrame | None:
        return storage.read_or_none(spark, f"{self.path}/commits", COMMITS)

    def _live(self, spark: SparkSession) -> tuple[int | None, int | None]:
        """(batch covered by the newest base, newest committed batch); from the commit log, a row for each batch or base."""
        commits = self._commits(spark)
        if commits is None:
            return None, None
        row = commits.agg(F.max(F.when(F.col("is_base"), F.col("batch_id"))).alias("base"),
                          F.max(F.when(~F.col("is_base"), F.col("batch_id"))).alias("batch")).first()
        return row["base"], row["batch"]

    def current(self, spark: SparkSession) -> DataFrame | None:
        """Latest row per key; ``None`` before the first batch."""
        covered, newest = self._live(spark)
        if newest is None:
            return None
        frames = [] if covered is None else [spark.read.parquet(f"{self.path}/base/covered={covered}")]
        after = self._commits(spark).filter(~F.col("is_base") & (F.col("batch_id") > (-1 if covered is None else covered)))
        batches = sorted(r["batch_id"] for r in after.select("batch_id").distinct().collect())  # less than ``fold``
        frames += [spark.read.parquet(f"{self.path}/data/batch={b}") for b in batches]
        return ops.latest_by_key(reduce(DataFrame.unionByName, frames), self.keys, self._order())

    def compact(self, spark: SparkSession) -> None:
        """Write the current snapshot as the next base. An interrupted one has no commit row and is written anew."""
        covered, newest = self._live(spark)
        if newest is None or covered == newest:
            return
        self.current(spark).write.mode("overwrite").parquet(f"{self.path}/base/covered={newest}")
        self._commit(spark, newest, is_base=True)

    def _commit(self, spark: SparkSession, batch_id: int, is_base: bool = False) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        spark.createDataFrame([(batch_id, now, is_base)], COMMITS).write.mode("append").parquet(f"{self.path}/commits")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commits = self._commits(spark)
        if commits is not None and not commits.filter(~F.col("is_base") & (F.col("batch_id") == batch_id)).isEmpty():
            return
        ops.latest_by_key(batch, self.keys, self._order()).write.mode("overwrite").parquet(f"{self.path}/data/batch={batch_id}")
        self._commit(spark, batch_id)
        if batch_id % self.fold == self.fold - 1:
            self.compact(spark)


def upsert_stream(
    stream: DataFrame,
    sink: SnapshotSink,
    checkpoint: str,
    available_now: bool = True,
):
    """Start the upsert stream; ``availableNow`` processes what exists, then stops."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def manifest_driven_silver(spark: SparkSession, base: str, checkpoint: str, available_now: bool = True):
    """I10 on the pipeline: every new successful manifest row triggers a merge
    of its run into the silver snapshot (the batch pipeline's ``merge_runs``).

    Streaming the page files themselves would expose runs that never
    committed; streaming the manifest log only sees committed runs.
    """
    from tidemark import schemas
    from tidemark.plans import pipeline
    from tidemark.sources.storage import Lake

    configure(spark)
    lake = Lake(spark, base)
    manifests = spark.readStream.schema(schemas.MANIFESTS).parquet(lake.manifests)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        runs = batch.filter(F.col("status") == "success").select(*REPO_KEYS, "run_id", "finished_at")
        pipeline.merge_runs(batch.sparkSession, base, runs, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))

    writer = manifests.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


# --------------------------------------------------------------------------
# Daily counts by event time
# --------------------------------------------------------------------------


def daily_counts_of(batch: DataFrame, keys: Sequence[str], ts_col: str, count_col: str = "event_count") -> DataFrame:
    """Partial counts of one micro-batch: per key and UTC day."""
    return batch.filter(F.col(ts_col).isNotNull()).groupBy(*keys, F.to_date(ts_col).alias("calendar_date")).agg(
        F.count(F.lit(1)).alias(count_col))


class DailyCountSink:
    """foreachBatch target: a folder of partial daily counts for each batch,
    which a replayed batch writes anew; their sums are current. No state and no
    watermark, so rows count however late they arrive."""

    def __init__(self, path: str, keys: Sequence[str], ts_col: str, schema: T.StructType, count_col: str = "event_count"):
        self.path = path.rstrip("/")
        kept = [schema[k] for k in keys]
        self.schema = T.StructType([*kept, T.StructField("calendar_date", T.DateType()), T.StructField(count_col, T.LongType())])
        self.keys = list(keys)
        self.ts_col = ts_col
        self.count_col = count_col

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        counts = daily_counts_of(batch, self.keys, self.ts_col, self.count_col)
        counts.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def current(self, spark: SparkSession) -> DataFrame:
        """The counts so far; an empty table before the first batch."""
        return storage.read_or_empty(spark, self.path, self.schema).groupBy(*self.keys, "calendar_date").agg(
            F.sum(self.count_col).alias(self.count_col))


def run_daily_counts(
    spark: SparkSession,
    stream: DataFrame,
    keys: Sequence[str],
    ts_col: str,
) -> DataFrame:
    """Run I11 over everything available now; return the current counts."""
    sink = DailyCountSink(scratch(spark, "daily-counts"), keys, ts_col, stream.schema)
    q = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", scratch(spark, "daily-counts-ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return sink.current(spark)
