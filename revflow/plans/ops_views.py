"""Operations views over the control tables.

The clock (``as_of``) and thresholds are arguments, so every view is
reproducible. Latest-per-group uses ``row_number() = 1`` (a partial top-1
before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revflow.operators.dedup import latest_per_key

SUCCESS_STATUSES = ("success", "partial_success")
# Freshness thresholds of the ops views.
STALE_LAYERS = ("bronze", "silver", "gold")
STALE_MINUTES = 30
SNAPSHOT_LAYER = "gold_snapshot"
STALE_SNAPSHOT_HOURS = 26


def _age_seconds(as_of: str | Column, col: str = "updated_ts") -> Column:
    """Seconds from ``col`` to ``as_of`` (an ISO string or a timestamp column)."""
    clock = F.to_timestamp(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return F.unix_timestamp(clock) - F.unix_timestamp(F.col(col).cast("timestamp"))


def recent_runs(registry: DataFrame) -> DataFrame:
    """L1: all runs, newest first."""
    return registry.orderBy(F.col("created_ts").desc())


def failed_runs(registry: DataFrame) -> DataFrame:
    """F8 + L2: failed runs, latest update first."""
    return registry.filter(F.col("status") == "failed").orderBy(F.col("updated_ts").desc())


def successful_runs(registry: DataFrame) -> DataFrame:
    """F9."""
    return registry.filter(F.col("status").isin(*SUCCESS_STATUSES))


def layer_freshness(registry: DataFrame, as_of: str) -> DataFrame:
    """Latest successful run per (entity, layer) and minutes since it."""
    latest = latest_per_key(successful_runs(registry), ["entity_name", "layer_name"], ["updated_ts", "run_id"])
    return latest.withColumn("minutes_since_success", F.round(_age_seconds(as_of) / F.lit(60.0), 2))


def stale_watermarks(watermarks: DataFrame, as_of: str | Column, stale_minutes: int = STALE_MINUTES,
                     stale_snapshot_hours: int = STALE_SNAPSHOT_HOURS) -> DataFrame:
    """O1 over F10: minutes since update and a freshness status per current watermark.

    ``as_of`` may be a column, so several clocks can be evaluated in one pass
    over the watermarks (see ``stale_watermarks_at``)."""
    age = _age_seconds(as_of)
    layer = F.col("layer_name")
    status = (F.when(layer.isin(*STALE_LAYERS) & (age / F.lit(60.0) > stale_minutes),
                     F.concat(F.lit("STALE_"), F.upper(layer)))
              .when((layer == SNAPSHOT_LAYER) & (age / F.lit(3600.0) > stale_snapshot_hours), F.lit("STALE_SNAPSHOT"))
              .otherwise(F.lit("OK")))
    return watermarks.filter(F.col("is_current") == F.lit(True)).select(
        "*", F.round(age / F.lit(60.0), 2).alias("minutes_since_watermark_update"), status.alias("freshness_status"))


def stale_watermarks_at(watermarks: DataFrame, clocks: list[str], **kw) -> DataFrame:
    """O1 at several clocks in one pass: each current watermark is paired with
    every clock by a generator (the clock list is a fixed, small argument), so
    the watermark fold is computed once, not once per clock."""
    current = watermarks.filter(F.col("is_current") == F.lit(True))
    at = current.withColumn("as_of", F.explode(F.array(*[F.to_timestamp(F.lit(c)) for c in clocks])))
    out = stale_watermarks(at, F.col("as_of"), **kw)
    return out.select(*[c for c in out.columns if c != "as_of"], "as_of")


def quarantine_summary(bad_records: DataFrame) -> DataFrame:
    """A2: quarantined rows per entity, layer, rule, status and day."""
    return bad_records.groupBy(
        "entity_name", "layer_name", "failed_rule_name", "status", F.to_date("quarantined_ts").alias("quarantine_date")
    ).agg(F.count(F.lit(1)).alias("quarantined_record_count"), F.max("quarantined_ts").alias("latest_quarantine_ts"))


def health_summary(registry: DataFrame, as_of: str, stale_minutes: int = STALE_MINUTES) -> DataFrame:
    """Latest run per (entity, layer) of any status and a RED/AMBER/GREEN flag."""
    latest = latest_per_key(registry, ["entity_name", "layer_name"], ["updated_ts", "run_id"])
    st = F.col("status")
    health = (F.when(st == "failed", F.lit("RED")).when(st == "partial_success", F.lit("AMBER"))
              .when(_age_seconds(as_of) / F.lit(60.0) > stale_minutes, F.lit("AMBER")).otherwise(F.lit("GREEN")))
    return latest.select("entity_name", "layer_name", st.alias("latest_status"), F.col("updated_ts").alias("latest_run_ts"),
                         "source_row_count", "rows_quarantined", health.alias("health_status"))


def run_metrics(registry: DataFrame) -> DataFrame:
    """Runs, success rate, rows ingested and quarantined, mean runtime per (entity, layer)."""
    st = F.col("status")
    runtime = F.unix_timestamp(F.col("run_end_ts").cast("timestamp")) - F.unix_timestamp(
        F.col("run_start_ts").cast("timestamp"))
    return registry.groupBy("entity_name", "layer_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(st.isin(*SUCCESS_STATUSES)).alias("succeeded_runs"),
        F.count_if(st == "failed").alias("failed_runs"),
        F.sum("source_row_count").alias("rows_ingested"),
        F.sum("rows_quarantined").alias("rows_quarantined"),
        F.avg(runtime).alias("avg_runtime_seconds"),
    ).withColumn("success_rate", F.col("succeeded_runs") / F.col("runs"))


def schema_drift(expected: T.StructType, actual: T.StructType, spark) -> DataFrame:
    """New, missing and retyped columns of a feed against its declared schema.

    Schemas are metadata (a handful of fields), so this is built on the driver.
    """
    exp = {f.name: f.dataType.simpleString() for f in expected.fields}
    act = {f.name: f.dataType.simpleString() for f in actual.fields}
    rows = []
    for n in sorted(set(exp) | set(act)):
        if n not in exp:
            rows.append((n, "NEW_COLUMN", None, act[n]))
        elif n not in act:
            rows.append((n, "MISSING_COLUMN", exp[n], None))
        elif exp[n] != act[n]:
            rows.append((n, "TYPE_CHANGED", exp[n], act[n]))
    return spark.createDataFrame(rows, "column_name string, change string, expected_type string, actual_type string")


def landed_drift(lines: DataFrame, declared: T.StructType) -> DataFrame:
    """X26 over landed JSON files: each column that is new, missing or of another type, in how many files, and the first of them.

    ``lines`` are the files' lines (``value``) with ``file`` and ``landed`` (its time). One pass over the lines gives a row for each
    file, column and type (combined before its shuffle); the fold over files is as small as the number of files.
    """
    entries = lines.select("file", "landed", F.explode(F.from_json("value", "map<string,string>")).alias("column_name", "text")).filter(F.col("text").isNotNull())
    kind = F.when(F.col("text").rlike(r"^-?[0-9]+$"), "bigint").when(F.col("text").try_cast("double").isNotNull(), "double").when(
        F.col("text").isin("true", "false"), "boolean").otherwise("string")
    seen = entries.groupBy("file", "landed", "column_name").agg(F.collect_set(kind).alias("kinds"))
    numeric = F.when(F.size("kinds") == 1, F.col("kinds")[0]).when(
        F.forall("kinds", lambda k: k.isin("bigint", "double")), "double").otherwise("string")
    found = seen.select("file", "landed", "column_name", numeric.alias("actual_type"))
    files = lines.select("file", "landed").distinct()
    rule = F.array(*(F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("expected_type")) for f in declared.fields))
    expected = files.select("file", "landed", F.inline(rule))  # the declared columns of each file
    both = expected.join(found, ["file", "landed", "column_name"], "full_outer")
    change = (F.when(F.col("expected_type").isNull(), "NEW_COLUMN").when(F.col("actual_type").isNull(), "MISSING_COLUMN")
              .when((F.col("expected_type") != F.col("actual_type")) & ~((F.col("expected_type") == "double") & (F.col("actual_type") == "bigint")), "TYPE_CHANGED"))
    return both.withColumn("change", change).filter("change is not null").groupBy("column_name", "change", "expected_type").agg(
        F.max("actual_type").alias("actual_type"), F.count(F.lit(1)).alias("files"), F.min("landed").alias("first_landed"),
        F.min_by("file", "landed").alias("first_file"))
