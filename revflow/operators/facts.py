"""Gold facts: business projection (P7-P11), activity union (P12, U1) and merges (M2, M3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revflow.functions.columns import col_or_null, delete_flag, mapped_select, with_fact_derivations
from revflow.operators.dedup import ensure_unique
from revflow.spec import EntitySpec

# The conformed activity projection, (target, source) in output order.
ACTIVITY_MAPPING = (
    ("activity_id", "activityid"),
    ("opportunity_id", "regardingobjectid"),
    ("owner_id", "ownerid"),
    ("subject", "subject"),
    ("scheduled_start", "scheduledstart"),
    ("scheduled_end", "scheduledend"),
    ("actual_end", "actualend"),
    ("created_ts", "createdon"),
    ("modified_ts", "modifiedon"),
    ("status_code", "statuscode"),
    ("state_code", "statecode"),
)
_ACTIVITY_NULL_TYPES = {
    "activity_id": T.LongType(), "opportunity_id": T.LongType(), "owner_id": T.LongType(),
    "scheduled_start": T.TimestampType(), "scheduled_end": T.TimestampType(), "actual_end": T.TimestampType(),
    "created_ts": T.TimestampType(), "modified_ts": T.TimestampType(),
}


def _audit(silver: DataFrame, active_col: str, gold_ts: Column | None) -> list[Column]:
    return [
        col_or_null(silver, active_col, "is_active", T.BooleanType()),
        col_or_null(silver, "silver_last_event_ts", "source_event_ts", T.TimestampType()),
        col_or_null(silver, "silver_last_run_id", "source_run_id"),
        col_or_null(silver, "silver_updated_ts", "gold_source_updated_ts", T.TimestampType()),
        (gold_ts if gold_ts is not None else F.current_timestamp()).alias("gold_updated_ts"),
    ]


def build_fact_rows(silver: DataFrame, spec: EntitySpec, gold_ts: Column | None = None) -> DataFrame:
    """The merge source for one entity, with ``gold_delete_flag``."""
    if not spec.column_mapping:
        raise ValueError(f"entity {spec.name} has no gold column mapping")
    fact = silver.select(*mapped_select(silver, spec.column_mapping, dict(spec.absent_types)),
                         *_audit(silver, spec.active_flag_column, gold_ts))
    weighted = (spec.weighted.amount_column, spec.weighted.probability_column) if spec.weighted else None
    fact = with_fact_derivations(fact, weighted).withColumn("gold_delete_flag", delete_flag("is_active"))
    if not spec.business_key or spec.business_key not in fact.columns:
        raise ValueError(f"{spec.name}: the mapped fact has no key column {spec.business_key!r}")
    return fact


def current_fact(silver: DataFrame, spec: EntitySpec, gold_ts: Column | None = None) -> DataFrame:
    """The gold table as a full refresh: active rows only, flag dropped.

    Equal to merging every silver increment with M2, because a soft-deleted
    silver row always carries a newer ``silver_updated_ts`` than its upsert.
    """
    fact = build_fact_rows(silver, spec, gold_ts)
    return fact.filter(~F.col("gold_delete_flag")).drop("gold_delete_flag")


def select_activity(silver: DataFrame, activity_type: str, gold_ts: Column | None = None) -> DataFrame:
    """The 17-column conformed activity projection with its type tag."""
    m = mapped_select(silver, ACTIVITY_MAPPING, _ACTIVITY_NULL_TYPES)
    return silver.select(
        m[0], F.lit(activity_type).alias("activity_type"), *m[1:], *_audit(silver, "is_active", gold_ts)
    )


def activity_rows(silver: DataFrame, activity_type: str, gold_ts: Column | None = None) -> DataFrame:
    """P12 + P11 of one kind: its projection with ``gold_delete_flag``."""
    return select_activity(silver, activity_type, gold_ts).withColumn("gold_delete_flag", delete_flag("is_active"))


def build_activity_rows(phonecall: DataFrame, appointment: DataFrame, gold_ts: Column | None = None,
                        duplicates: str | None = None) -> DataFrame:
    """U1 + P11: both kinds by name, with ``gold_delete_flag``.

    One id present in both kinds would hit one target row twice; ``duplicates``
    = ``error`` refuses that, ``latest`` keeps the newer change (by source event
    time, then gold source time, then kind); None leaves the input as is.
    """
    df = select_activity(phonecall, "phonecall", gold_ts).unionByName(
        select_activity(appointment, "appointment", gold_ts), allowMissingColumns=True
    )
    if duplicates:
        df = ensure_unique(df, ["activity_id"], duplicates,
                           ["source_event_ts", "gold_source_updated_ts", "activity_type"])
    return df.withColumn("gold_delete_flag", delete_flag("is_active"))


def current_activity(phonecall: DataFrame, appointment: DataFrame, gold_ts: Column | None = None,
                     duplicates: str | None = None) -> DataFrame:
    """fact_activity as a full refresh (M3 applied to an empty target)."""
    rows = build_activity_rows(phonecall, appointment, gold_ts, duplicates)
    return rows.filter(~F.col("gold_delete_flag")).drop("gold_delete_flag")
