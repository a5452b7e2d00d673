"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Quality rules, SimHash near-duplicates, benchmark decontamination, mixing sources
to target weights, sharding. A stage takes (spark, docs, sf_dir) and works on all
that its predecessor kept; its rows are what the next one reads. All but the last
return the columns of ``documents``; the last adds ``shard`` and ``slot``.

Null texts have no words, so the first stage rejects them; empty input passes
through all stages as an empty table; extra columns of ``docs`` are carried along.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, mixing, quality, sharding, simhash
from tidemark.llm.common import shared_dir, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is good."""
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return simhash.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: for each pass over a source, the words of its documents that the mix takes."""
    return mixing.mixed_documents(docs)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows of the mix with their shard and slot."""
    return sharding.sharded_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
    ("shard_documents", shard_documents),
]

#: EM, fingerprints and label propagation are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{base}/{number}-{name}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
