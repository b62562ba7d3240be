"""Timed snapshots of the opportunity fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from revflow.functions.columns import money_sum, with_snapshot_stamp
from revflow.operators.merge import merge_snapshot
from revflow.spec import OPPORTUNITY, EntitySpec


def build_snapshot(fact: DataFrame, snapshot_ts: str, run_id: str, spec: EntitySpec = OPPORTUNITY,
                   created_ts: Column | None = None) -> DataFrame:
    """Stamp every current fact row with the snapshot time and its ages."""
    if spec.snapshot is None:
        raise ValueError(f"{spec.name} has no snapshot settings")
    return with_snapshot_stamp(fact, snapshot_ts, run_id, spec.snapshot.grain, created_ts)


def upsert_snapshot(target: DataFrame | None, snap: DataFrame, spec: EntitySpec = OPPORTUNITY) -> DataFrame:
    """M4: idempotent on (snapshot_ts, business key); other dates stay untouched."""
    keys = list(spec.snapshot.keys) if spec.snapshot else ["snapshot_ts", spec.business_key]
    if target is None:
        target = snap.limit(0)
    return merge_snapshot(target, snap, keys)


def stored_snapshots(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored snapshots, partitioned by ``snapshot_date``; None before the first."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def store_snapshot(path: str, snap: DataFrame, snapshot_ts: str, spec: EntitySpec = OPPORTUNITY) -> None:
    """M4 on storage: upsert the snapshot of ``snapshot_ts`` into its date's partition with Spark's dynamic partition overwrite.

    Only that date is read and replaced; the other dates' files stay. A rerun replaces its own rows; rows of the date's other
    snapshot times, and those of keys that left since, are kept.
    """
    stored = stored_snapshots(snap.sparkSession, path)
    if stored is not None:
        stored = stored.filter(F.col("snapshot_date") == F.to_date(F.to_timestamp(F.lit(snapshot_ts))))
        snap = upsert_snapshot(stored, snap, spec)
    snap.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


# --- movement between stored snapshots (X25) ---------------------------------

def moved(snap: DataFrame, carried: DataFrame | None, key: str, stage: str = "stage_name", amount: str = "estimated_value") -> DataFrame:
    """One date's snapshot against each key's last state before it: previous stage and amount, and what changed."""
    if carried is None:
        carried = snap.limit(0).select(key, stage, amount)
    last = carried.select(F.col(key).alias("__key"), F.col(stage).alias("previous_stage"), F.col(amount).alias("previous_amount"))
    movement = F.when(F.col("previous_stage").isNull(), "NEW").when(F.col("previous_stage") != F.col(stage), "MOVED").otherwise("SAME")
    return snap.join(last, F.col(key) == F.col("__key"), "left").select(
        key, "snapshot_date", stage, amount, "previous_stage", "previous_amount",
        (F.col(amount) - F.col("previous_amount")).alias("amount_change"), movement.alias("movement"))


def carry(snap: DataFrame, carried: DataFrame | None, key: str, stage: str = "stage_name", amount: str = "estimated_value") -> DataFrame:
    """Each key's last state up to a snapshot: its row there, or what was carried for a key that is not in it."""
    now = snap.select(key, stage, amount)
    return now if carried is None else now.unionByName(carried.select(key, stage, amount).join(now.select(key), key, "left_anti"))


def store_movement(spark: SparkSession, snapshots: DataFrame, root: str, date: str, key: str) -> None:
    """X25 for one date: read its snapshot and the states carried from the date before, write both of its partitions anew.

    What is read does not depend on how many dates are stored. ``root/moved`` holds the movements, ``root/carried`` the last states, both
    by ``snapshot_date``. Dates come in order; a date that is stored again replaces its own partitions.
    """
    day = F.to_date(F.lit(date))
    snap = snapshots.filter(F.col("snapshot_date") == day)  # one partition
    stored = stored_snapshots(spark, f"{root}/carried")
    before = None
    if stored is not None:
        last = stored.filter(F.col("snapshot_date") < day).agg(F.max("snapshot_date")).first()[0]  # partition values only
        before = None if last is None else stored.filter(F.col("snapshot_date") == F.lit(last))
    for name, rows in (("moved", moved(snap, before, key)), ("carried", carry(snap, before, key).withColumn("snapshot_date", day))):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(f"{root}/{name}")


def pipeline_trend(snapshots: DataFrame, dates: DataFrame, stage: str = "stage_name", amount: str = "estimated_value") -> DataFrame:
    """Rows and value of each stage on each of ``dates`` and the change from its date before.

    ``dates`` (column ``snapshot_date``) is a filtered calendar; its join prunes the snapshots' partitions at run time. The window runs
    over one row for each date and stage.
    """
    by_stage = snapshots.join(F.broadcast(dates), "snapshot_date").groupBy("snapshot_date", stage).agg(
        F.count(F.lit(1)).alias("opportunity_count"), money_sum(amount).alias("pipeline_value"))
    before = Window.partitionBy(stage).orderBy("snapshot_date")
    return by_stage.select(
        "snapshot_date", stage, "opportunity_count", "pipeline_value",
        (F.col("opportunity_count") - F.lag("opportunity_count").over(before)).alias("count_change"),
        F.round(F.col("pipeline_value") - F.lag("pipeline_value").over(before), 2).alias("value_change"))
