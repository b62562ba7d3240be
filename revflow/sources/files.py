"""Feed files: format selection, schema discovery, batch reads and appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMATS = ("parquet", "json", "csv", "orc")


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported file format {fmt!r}; expected one of {FORMATS}")
    return fmt


def infer_feed_schema(spark: SparkSession, path: str, fmt: str = "parquet") -> T.StructType:
    """The merged schema of every landed file (additive columns included)."""
    reader = spark.read.format(check_format(fmt)).option("mergeSchema", "true")
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "true")
    return reader.load(path).schema


def read_feed(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """A batch read of a feed or table."""
    reader = spark.read.format(check_format(fmt))
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.option("mergeSchema", "true").load(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows, partitioned (by entity, ingestion date, ...)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
