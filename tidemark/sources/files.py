"""File-level helpers from the walkthrough: JSON array scan, Parquet export,
schema description and run-id formatting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed value: run-id format of a manually started run.
RUN_ID_FORMAT = "manual__%Y-%m-%dT%H-%M-%SZ"


def run_id_for(started: dt.datetime) -> str:
    """the run id of a run started at ``started`` (UTC)."""
    return started.strftime(RUN_ID_FORMAT)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Files holding one JSON array of objects each, one row per object.

    Without a schema it is inferred (a sampling pass); pass the declared schema
    in production so the scan is a single pass.
    """
    reader = spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def export_parquet(df: DataFrame, path: str) -> int:
    """Write ``df`` as Parquet and count what reads back from the files."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def describe(df: DataFrame) -> DataFrame:
    """Column name, type and nullability, as a small DataFrame (schema metadata)."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "col_name string, data_type string, nullable boolean")
