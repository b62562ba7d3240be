"""Entity specifications: the per-feed settings every operator takes as arguments.

Values that must equal the original configuration for identical results are
kept together below as fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class WeightedAmount:
    amount_column: str = "estimated_value"
    probability_column: str = "probability"


@dataclass(frozen=True)
class SnapshotSpec:
    grain: str = "daily"
    keys: tuple[str, ...] = ("snapshot_ts", "opportunity_id")


@dataclass(frozen=True)
class EntitySpec:
    name: str
    primary_key: str
    event_time_column: str = "modifiedon"
    active_flag_column: str = "is_active"
    operation_column: str | None = "change_operation"
    delete_values: tuple[str, ...] = ("DELETE", "D")
    update_values: tuple[str, ...] = ("UPDATE", "U")
    insert_values: tuple[str, ...] = ("INSERT", "I")
    source_type: str = "dataverse_synapse_link"
    write_mode: str = "append_only"
    delete_handling: str = "process_delete_events"
    delete_strategy: str = "soft_delete"  # or "hard_delete"
    mandatory_columns: tuple[str, ...] = ()
    non_negative_columns: tuple[str, ...] = ()
    business_key: str | None = None
    # (target, source) pairs, in output order
    column_mapping: tuple[tuple[str, str], ...] = ()
    weighted: WeightedAmount | None = None
    snapshot: SnapshotSpec | None = None
    activity_type: str | None = None
    serving_view: str | None = None
    snapshot_view: str | None = None
    quarantine_enabled: bool = True  # D6: without it, bad rows are counted but not stored
    dedup_enabled: bool = True  # W1: without it, a key that changes twice in one increment is an error
    # (gold column, type) pairs that a mapped column takes where its source is absent; others are STRING
    absent_types: tuple[tuple[str, str], ...] = (
        ("created_ts", "timestamp"), ("modified_ts", "timestamp"), ("expected_close_date", "date"),
        ("start_date", "timestamp"), ("end_date", "timestamp"), ("estimated_value", "double"), ("probability", "double"),
        ("quote_amount", "double"), ("contract_value", "double"),
    )

    def with_(self, **kw) -> "EntitySpec":
        from dataclasses import replace

        return replace(self, **kw)


# ---------------------------------------------------------------------------
# Entity settings of the original CRM configuration (keys, event
# column, quality rules, gold column mappings, view names), stated as given.
# ---------------------------------------------------------------------------
OPPORTUNITY = EntitySpec(
    name="opportunity",
    primary_key="opportunityid",
    mandatory_columns=("opportunityid", "createdon"),
    non_negative_columns=("estimatedvalue",),
    business_key="opportunity_id",
    column_mapping=(
        ("opportunity_id", "opportunityid"),
        ("opportunity_name", "name"),
        ("owner_id", "ownerid"),
        ("account_id", "customerid"),
        ("created_ts", "createdon"),
        ("modified_ts", "modifiedon"),
        ("expected_close_date", "estimatedclosedate"),
        ("estimated_value", "estimatedvalue"),
        ("probability", "closeprobability"),
        ("status_code", "statuscode"),
        ("state_code", "statecode"),
        ("stage_name", "stepname"),
    ),
    weighted=WeightedAmount("estimated_value", "probability"),
    snapshot=SnapshotSpec("daily", ("snapshot_ts", "opportunity_id")),
    serving_view="vw_opportunity_pipeline",
    snapshot_view="vw_pipeline_snapshot",
)

QUOTE = EntitySpec(
    name="quote",
    primary_key="quoteid",
    mandatory_columns=("quoteid",),
    non_negative_columns=("totalamount",),
    business_key="quote_id",
    column_mapping=(
        ("quote_id", "quoteid"),
        ("opportunity_id", "opportunityid"),
        ("quote_name", "name"),
        ("quote_number", "quotenumber"),
        ("quote_amount", "totalamount"),
        ("created_ts", "createdon"),
        ("modified_ts", "modifiedon"),
        ("status_code", "statuscode"),
        ("state_code", "statecode"),
    ),
    serving_view="vw_quote_conversion",
)

CONTRACT = EntitySpec(
    name="contract",
    primary_key="contractid",
    mandatory_columns=("contractid",),
    non_negative_columns=("totalprice",),
    business_key="contract_id",
    column_mapping=(
        ("contract_id", "contractid"),
        ("opportunity_id", "opportunityid"),
        ("quote_id", "quoteid"),
        ("contract_name", "title"),
        ("contract_value", "totalprice"),
        ("start_date", "activeon"),
        ("end_date", "expireson"),
        ("created_ts", "createdon"),
        ("modified_ts", "modifiedon"),
        ("status_code", "statuscode"),
        ("state_code", "statecode"),
    ),
    serving_view="vw_contract_bookings",
)

PHONECALL = EntitySpec(
    name="phonecall",
    primary_key="activityid",
    mandatory_columns=("activityid",),
    business_key="activity_id",
    activity_type="phonecall",
    serving_view="vw_sales_activity",
)

APPOINTMENT = EntitySpec(
    name="appointment",
    primary_key="activityid",
    mandatory_columns=("activityid",),
    business_key="activity_id",
    activity_type="appointment",
    serving_view="vw_sales_activity",
)

PIPELINE_ITEM = EntitySpec(
    name="pipeline_item",
    primary_key="pipelineitemid",
    mandatory_columns=("pipelineitemid",),
    serving_view="vw_pipeline_items",
)

ENTITIES = {s.name: s for s in (OPPORTUNITY, QUOTE, CONTRACT, PHONECALL, APPOINTMENT, PIPELINE_ITEM)}

# Trigger modes accepted by the bronze stream (S6) and the default interval.
TRIGGER_MODES = ("available_now", "micro_batch", "continuous")
DEFAULT_MICROBATCH_INTERVAL = "5 minutes"
