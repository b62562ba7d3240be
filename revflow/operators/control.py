"""Control tables as append-only event logs.

UPDATE statements on a registry become appended events; the current state is
a fold: per key, each column takes its last non-NULL value in event order.
Folds are partial aggregations, so a busy key never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


RUN_REGISTRY_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("parent_run_id", T.StringType()),
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("entity_name", T.StringType()),
    T.StructField("layer_name", T.StringType()),
    T.StructField("trigger_type", T.StringType()),
    T.StructField("attempt_no", T.IntegerType()),
    T.StructField("run_start_ts", T.TimestampType()),
    T.StructField("run_end_ts", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("source_high_watermark", T.StringType()),
    T.StructField("source_row_count", T.LongType()),
    T.StructField("target_row_count", T.LongType()),
    T.StructField("rows_quarantined", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("created_ts", T.TimestampType()),
    T.StructField("updated_ts", T.TimestampType()),
])

WATERMARK_SCHEMA = T.StructType([
    T.StructField("entity_name", T.StringType(), False),
    T.StructField("layer_name", T.StringType(), False),
    T.StructField("watermark_type", T.StringType(), False),
    T.StructField("watermark_value", T.StringType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("is_current", T.BooleanType(), False),
    T.StructField("updated_ts", T.TimestampType(), False),
])

#: Column names and types of the quarantine envelope.
BAD_RECORDS_SCHEMA = T.StructType([
    T.StructField("quarantine_id", T.StringType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("entity_name", T.StringType(), False),
    T.StructField("layer_name", T.StringType(), False),
    T.StructField("record_key", T.StringType()),
    T.StructField("failed_rule_name", T.StringType()),
    T.StructField("failure_reason", T.StringType()),
    T.StructField("raw_record", T.StringType()),
    T.StructField("source_file_path", T.StringType()),
    T.StructField("status", T.StringType(), False),
    T.StructField("quarantined_ts", T.TimestampType(), False),
])

def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed empty table."""
    return spark.createDataFrame([], schema)


# --- run registry events (M6, M7) -------------------------------------------

def run_start_event(spark: SparkSession, run_id: str, parent_run_id: str | None, pipeline_name: str,
                    entity_name: str, layer_name: str, trigger_type: str, attempt_no: int, ts) -> DataFrame:
    row = dict(run_id=run_id, parent_run_id=parent_run_id, pipeline_name=pipeline_name, entity_name=entity_name,
               layer_name=layer_name, trigger_type=trigger_type, attempt_no=attempt_no, run_start_ts=ts,
               status="running", rows_quarantined=0, created_ts=ts, updated_ts=ts)
    return spark.createDataFrame([row], RUN_REGISTRY_SCHEMA)


def run_end_event(spark: SparkSession, run_id: str, ts, status: str | None = None,
                  source_high_watermark: str | None = None, source_row_count: int | None = None,
                  target_row_count: int | None = None, rows_quarantined: int | None = None,
                  error_message: str | None = None) -> DataFrame:
    """log_success (status from the quarantine count), log_failure or skip."""
    if status is None:
        status = "partial_success" if rows_quarantined and rows_quarantined > 0 else "success"
    if error_message is not None:
        error_message = str(error_message)
    row = dict(run_id=run_id, run_end_ts=ts, status=status, source_high_watermark=source_high_watermark,
               source_row_count=source_row_count, target_row_count=target_row_count,
               rows_quarantined=rows_quarantined, error_message=error_message, updated_ts=ts)
    return spark.createDataFrame([row], RUN_REGISTRY_SCHEMA)


def fold_latest(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key, each column's last non-NULL value under ``order`` (ascending)."""
    ordering = F.struct(*[F.col(c) for c in order])
    aggs = []
    for c in events.columns:
        if c in keys:
            continue
        aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordering)).alias(c))
    return events.groupBy(*keys).agg(*aggs).select(*events.columns)


def fold_runs(events: DataFrame, order: Sequence[str] = ("updated_ts",)) -> DataFrame:
    """Current run registry from its events (one row per ``run_id``). An end counts after every start, whatever the clocks say."""
    ended = "__ended"
    marked = events.withColumn(ended, F.coalesce(F.col("status") != "running", F.lit(False)))
    return fold_latest(marked, ["run_id"], [ended, *order]).drop(ended)


# --- watermarks (M5, F3, F10) ----------------------------------------------

def watermark_event(spark: SparkSession, entity: str, layer: str, wm_type: str, value: str,
                    run_id: str, ts) -> DataFrame:
    row = dict(entity_name=entity, layer_name=layer, watermark_type=wm_type, watermark_value=value,
               run_id=run_id, is_current=True, updated_ts=ts)
    return spark.createDataFrame([row], WATERMARK_SCHEMA)


def mark_current(watermarks: DataFrame, order: Sequence[str] = ("updated_ts", "run_id")) -> DataFrame:
    """M5: ``is_current`` is true only for the latest row per (entity, layer); equal times go to the later run id."""
    latest = watermarks.groupBy("entity_name", "layer_name").agg(
        F.max(F.struct(*[F.col(c) for c in order])).alias("__latest"))
    joined = watermarks.join(latest, ["entity_name", "layer_name"], "left")
    cur = F.struct(*[F.col(c) for c in order]) == F.col("__latest")
    return joined.withColumn("is_current", F.coalesce(cur, F.lit(False))).select(*watermarks.columns)


def current_watermarks(watermarks: DataFrame, order: Sequence[str] = ("updated_ts", "run_id")) -> DataFrame:
    """F10 over the fold: one current row per (entity, layer), from one scan."""
    return fold_latest(watermarks.drop("is_current"), ["entity_name", "layer_name"], order).withColumn(
        "is_current", F.lit(True))


def get_current_watermark(watermarks: DataFrame, entity: str, layer: str) -> Column | None:
    """the current watermark of (entity, layer) as a scalar, or None."""
    row = (watermarks.filter((F.col("entity_name") == entity) & (F.col("layer_name") == layer)
                             & F.col("is_current"))
           .agg(F.max_by("watermark_value", "updated_ts").alias("wm")).first())
    return row["wm"] if row else None


def latest_watermark(events: DataFrame, entity: str, layer: str) -> str | None:
    """F3 on the watermark events themselves: one filtered ``max_by``. Equal times go to the later run id."""
    own = events.filter((F.col("entity_name") == entity) & (F.col("layer_name") == layer))
    return own.agg(F.max_by("watermark_value", F.struct("updated_ts", "run_id"))).first()[0]
