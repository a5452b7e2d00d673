"""Helpers shared by the operators: table access, shared-folder tables, word bytes."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java pattern of one word: everything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Spark's setting that removes a query's shuffle files at its end.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: ASCII white space, as ``bytes.split()`` splits.
SPACES = b" \t\n\x0b\x0c\r"

#: Where ``materialize`` wrote the tables that are still referred to.
WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
#: Bytes that start a UTF-8 code point.
IS_START = (np.arange(256) & 0xC0) != 0x80


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as ``spark.checkpoint.dir`` names it.

    A session without the setting gets a private folder only when its master is
    local (tests): there one machine holds every task. A cluster session without
    it is an error, since executors could not read each other's files.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage with files that every executor can read, so a lost executor
    costs at most the running stage, and several readers share one computation.
    Once the table is written, the shuffle files that made it are not needed and
    are removed, instead of staying until the driver collects its garbage.
    """
    return materialize_parts(df, name)[0]


def materialize_parts(df: DataFrame, name: str, part: Column | None = None, parts: int = 1) -> list[DataFrame]:
    """As ``materialize``, but a table for each value of ``part``, from 0 to ``parts`` - 1, that can be released alone."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    own = unused(df.columns, "part")
    writer = df.write if part is None else df.withColumn(own, part).write.partitionBy(own)
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        writer.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
    paths = [path] if part is None else [f"{path}/{own}={k}" for k in range(parts)]
    tables = []
    for each in paths:
        if part is not None:  # a part without rows has no folder yet
            folder = spark._jvm.org.apache.hadoop.fs.Path(each)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(folder)
        tables.append(spark.read.schema(df.schema).parquet(each))
        WRITTEN[tables[-1]] = each
    return tables


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more: all that was made of them is written."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(WRITTEN.pop(table))
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def row_key() -> F.Column:
    """A key of (doc_id, text) that is never null, so null ids and repeated rows join too."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_rows(docs: DataFrame, rejected: DataFrame, key: str = "__row_key") -> DataFrame:
    """``docs`` without the rows whose key is in ``rejected`` (one column, ``key``)."""
    own = unused(docs.columns, key)
    wanted = rejected.select(F.col(key).alias(own)).distinct()
    return docs.withColumn(own, row_key()).join(wanted, own, "left_anti").select(*docs.columns)


def attach(docs: DataFrame, decisions: DataFrame, repeated: DataFrame, key: str = "__row_key") -> DataFrame:
    """The columns of ``docs`` and of ``decisions``, joined on the row key: one row per row of ``decisions``.

    ``repeated`` has the keys (column ``key``) of rows that ``docs`` holds more than once; their
    decisions are as many as the rows, so one copy of the row is joined with all of them.
    """
    own = unused(docs.columns, key)
    decisions, repeated = (df.withColumnRenamed(key, own) for df in (decisions, repeated))
    with_key = docs.withColumn(own, row_key())
    extra = [c for c in decisions.columns if c != own]
    if repeated.isEmpty():
        joined = with_key.join(decisions, own)
    else:
        one = with_key.join(repeated, own, "left_semi").dropDuplicates([own])
        joined = with_key.join(repeated, own, "left_anti").unionByName(one).join(decisions, own)
    return joined.select(*docs.columns, *extra)


def signed64(values: np.ndarray) -> np.ndarray:
    """uint64 as the int64 of the same bits (Spark has no unsigned long)."""
    return values.astype(np.uint64).view(np.int64)
