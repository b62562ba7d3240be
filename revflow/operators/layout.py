"""File layout maintenance (S13): compaction and clustering of a table version."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def compact(spark: SparkSession, src: str, dst: str, cluster_by: Sequence[str], rows_per_file: int = 1_000_000,
            partition_by: Sequence[str] = (), z_order: bool = False) -> DataFrame:
    """Rewrite ``src`` into ``dst`` as fewer, key-clustered files; with ``z_order`` clustered on all of ``cluster_by`` alike.

    Range partitioning on the cluster keys (sampled boundaries, no single
    reducer) followed by a sort inside each task gives one file per range with
    tight min/max statistics per key, which is what data skipping needs. The
    content is unchanged; publishing ``dst`` as the next version is the
    caller's (new-version-then-publish).
    """
    df = spark.read.parquet(src)
    n = max(1, math.ceil(df.count() / rows_per_file))
    rows = z_ordered(df, cluster_by, n) if z_order else df.repartitionByRange(n, *cluster_by).sortWithinPartitions(*cluster_by)
    w = rows.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(dst)
    return spark.read.parquet(dst)


def _number(df: DataFrame, column: str) -> Column:
    """A number in the order of the column's values (texts by their first seven bytes)."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.conv(F.hex(F.rpad(F.substring(F.col(column).cast("binary"), 1, 7), 7, b"\x00")), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def _rank(value: Column, splits: Sequence[float]) -> Column:
    """How many of the ordered ``splits`` are not above ``value``, by bisection; null counts as below all."""
    def at(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value >= F.lit(splits[mid]), at(mid + 1, hi)).otherwise(at(lo, mid))

    return at(0, len(splits))


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """The place of a row on the Z-curve over the ranks of ``columns``: their bits, interleaved from the highest.

    A column's ranks are its 2^bits ranges of about equally many rows; the 2^bits - 1 borders of each column (approximate percentiles,
    one aggregate for all columns) are all that reaches the driver.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    borders = df.agg(*(F.percentile_approx(_number(df, c), shares, 10_000).alias(c) for c in columns)).first()
    place = F.lit(0).cast("long")
    ranks = [_rank(_number(df, c), sorted(set(borders[c] or []))).cast("long") for c in columns]
    for bit in range(bits):
        for i, rank in enumerate(reversed(ranks)):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(one, bit * len(ranks) + i))
    return place


def z_ordered(df: DataFrame, columns: Sequence[str], files: int | None = None, bits: int = 6) -> DataFrame:
    """The rows dealt and sorted by their place on the Z-curve, so that every file covers a small range of each column.

    Readers skip by the files' statistics; Spark writes none for TIMESTAMP columns unless ``spark.sql.parquet.outputTimestampType`` is
    TIMESTAMP_MICROS.
    """
    place = "__z"
    rows = df.withColumn(place, z_value(df, columns, bits))
    dealt = rows.repartitionByRange(files, place, *columns) if files else rows.repartitionByRange(place, *columns)
    return dealt.sortWithinPartitions(place, *columns).drop(place)


def file_count(df: DataFrame) -> int:
    return len(df.inputFiles())
