"""Staging files: where a batch's events are written before they are merged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.jsonfmt import record_json
from tidemark.plans.envelope import is_json_format

BASE_FOLDER = "staged/changes"  # first part of a staging path
STAGING_PREFIX = "_staging_"


def staging_path(root: str, app: str, dataset: str, table: str, batch_id: int, snapshot: bool = False) -> str:
    """One folder a batch; snapshot and streaming batches of the same millisecond stay apart."""
    kind = "-snapshot" if snapshot else ""
    return f"{root.rstrip('/')}/{BASE_FOLDER}/{app}/{dataset}/{table}/{batch_id}{kind}"


def staging_table(table: str, prefix: str | None = STAGING_PREFIX) -> str:
    return f"{prefix or STAGING_PREFIX}{table}"


def write_staging(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Parquet, or JSON lines with explicit nulls."""
    if file_format == "json":
        df.select(record_json(df).alias("value")).write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").parquet(path)


def staging_format(schema: T.StructType) -> str:
    """JSON lines where a row-oriented binary file could not hold the batch; else Parquet, in the place of Avro."""
    return "json" if is_json_format(schema) else "parquet"


def read_staging(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet") -> DataFrame:
    if file_format != "json":
        return spark.read.schema(schema).parquet(path)
    formats = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "dateFormat": "yyyy-MM-dd"}
    return spark.read.schema(schema).options(mode="FAILFAST", **formats).json(path)
