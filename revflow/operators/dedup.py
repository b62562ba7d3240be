"""Latest row per key (W1) and the duplicate-key guard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def _order(spec: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in spec]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (strings mean DESC NULLS LAST).

    ``row_number() == 1`` plans as WindowGroupLimit: a partial top-1 runs on
    each map partition before the exchange, so the shuffle carries at most one
    row per key and partition, and a hot key never piles up in one task.
    Pass a unique column last in ``order`` to make ties deterministic.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def silver_order(tie_breakers: Sequence[str | Column] = ()) -> list[str | Column]:
    """The silver dedup order: event time, then ingest time, then tie-breakers."""
    return ["bronze_business_event_ts", "bronze_ingest_ts", *tie_breakers]


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count (aggregated map-side first)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def ensure_unique(df: DataFrame, keys: Sequence[str], mode: str = "error",
                  order: Sequence[str | Column] = ()) -> DataFrame:
    """Guard a merge source: ``error`` raises on a repeated key, ``latest`` keeps
    the first row under ``order``. The check is one partial aggregation; only
    a single existence probe reaches the driver."""
    if mode == "latest":
        return latest_per_key(df, keys, order)
    if mode == "error":
        if not duplicate_keys(df, keys).isEmpty():
            raise ValueError(f"merge source has duplicate keys on {list(keys)}")
        return df
    raise ValueError(f"unknown duplicate mode {mode!r}")
