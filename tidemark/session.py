"""Spark session set-up shared by the library, the tests and the bench.

Everything the library needs from the session is a runtime SQL setting, so
``configure`` can be applied to a session someone else built (a cluster
notebook, the driver's verify run) without restarting it.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime settings the library relies on for correct results.
#  * UTC session zone: day boundaries (created_date, closed_date, datediff)
#    must not depend on the machine that runs the job.
#  * partition type inference off: a repository named "007" stays "007".
#  * AQE on: runtime coalescing of shuffle partitions, skew-join splitting and
#    broadcast conversion driven by measured shuffle sizes.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library depends on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    Used by tests and the bench. On a cluster the session usually exists
    already; call ``configure`` on it instead.
    """
    cores = os.environ.get("BENCH_CPUS") or "8"
    builder = (
        SparkSession.builder.master(master or f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cores)))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediates.

    On a cluster this is the shared location named by ``spark.checkpoint.dir``;
    it is read from the session and never replaced. Only a session whose master is
    local (tests, one machine) may leave it unset and gets a private folder; on a
    cluster that is an error, since executors could not read each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scale_settings(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a job reading ``input_bytes`` (e.g. 100 TB).

    Scan splits and post-shuffle partitions target ``target_partition_bytes``
    so a task's data fits executor memory with room for sort/aggregation
    buffers; the initial shuffle width is sized from the input and AQE
    coalesces it down to the advisory size at run time, and splits skewed
    partitions of joins.
    """
    parts = max(200, -(-input_bytes // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def apply_scale_settings(spark: SparkSession, input_bytes: int) -> SparkSession:
    for key, value in scale_settings(input_bytes).items():
        spark.conf.set(key, value)
    return spark
