"""Registered queries: one per operator family, over whole input tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose columns and
values match the DuckDB oracle of the same name (``oracle_sql.ORACLES``).
Clocks are fixed (``as_of``), so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revflow.functions import quality as dq
from revflow.functions.quality import split_valid_invalid
from revflow.operators import control
from revflow.operators.dedup import latest_per_key
from revflow.operators.diff import table_diff
from revflow.operators.facts import current_activity, current_fact
from revflow.operators.fold import fold_feed
from revflow.operators.layout import compact, file_count
from revflow.operators.replay import replay_current_state
from revflow.operators.snapshot import build_snapshot, pipeline_trend, store_movement, store_snapshot, stored_snapshots
from revflow.plans import dims, marts, ops_views
from revflow.plans.medallion import append_batches, bronze_rows, checked, silver_increment, silver_state_of_feed
from revflow.plans.oracle_sql import AS_OF_OPS, AS_OF_SALES
from revflow.session import ensure_checkpoint_dir, scratch_path
from revflow.sources import crm_feeds as feeds
from revflow.sources.files import infer_feed_schema, read_feed
from revflow.sources.deltas import state_table
from revflow.spec import APPOINTMENT, CONTRACT, OPPORTUNITY, PHONECALL, QUOTE, EntitySpec
from revflow.streaming.cdc import CurrentStateWriter, start_current_state_stream
from revflow.streaming.ingest import bronze_stream, read_feed_stream, run_bronze_available_now

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The event change log as an entity of its own (key user_id).
EVENT_SPEC = EntitySpec(name="event_user", primary_key="user_id", mandatory_columns=("user_id",),
                        non_negative_columns=("amount",))
EVENT_TIE_BREAKERS = ("event_id",)


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def prepare(spark: SparkSession) -> None:
    """Pin the session clock zone so wall-clock fixture times round-trip exactly."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)


def finalize(df: DataFrame) -> DataFrame:
    """Present instants as TIMESTAMP_NTZ (the fixtures' and the oracle's type)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            out.append(F.col(f.name).cast(T.TimestampNTZType()).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _ts(s: str):
    return F.to_timestamp(F.lit(s))


# --- gold facts ---------------------------------------------------------------

def fact_opportunity(spark, sf) -> DataFrame:
    silver = silver_state_of_feed(feeds.opportunity_feed(spark, sf), OPPORTUNITY, "silver-opportunity",
                                  _ts(AS_OF_SALES))
    return current_fact(silver, OPPORTUNITY, _ts(AS_OF_SALES))


def fact_quote(spark, sf) -> DataFrame:
    silver = silver_state_of_feed(feeds.quote_changes(spark, sf), QUOTE, "silver-quote", _ts(AS_OF_SALES),
                                  feeds.QUOTE_TIE_BREAKERS)
    return current_fact(silver, QUOTE, _ts(AS_OF_SALES))


def fact_contract(spark, sf) -> DataFrame:
    silver = silver_state_of_feed(feeds.contract_feed(spark, sf), CONTRACT, "silver-contract", _ts(AS_OF_SALES))
    return current_fact(silver, CONTRACT, _ts(AS_OF_SALES))


def fact_activity(spark, sf) -> DataFrame:
    ts = _ts(AS_OF_OPS)
    phone = silver_state_of_feed(feeds.activity_feed(spark, sf, "phonecall"), PHONECALL, "silver-phonecall", ts)
    appt = silver_state_of_feed(feeds.activity_feed(spark, sf, "appointment"), APPOINTMENT, "silver-appointment", ts)
    return current_activity(phone, appt, ts)


@query("fact_opportunity")
def q_fact_opportunity(spark, sf):
    """Opportunity feed -> silver -> active gold fact."""
    prepare(spark)
    return finalize(fact_opportunity(spark, sf))


@query("fact_quote")
def q_fact_quote(spark, sf):
    """W1 over repeated quote keys, then P7, P9, M2."""
    prepare(spark)
    return finalize(fact_quote(spark, sf))


@query("fact_contract")
def q_fact_contract(spark, sf):
    prepare(spark)
    return finalize(fact_contract(spark, sf))


@query("fact_activity")
def q_fact_activity(spark, sf):
    """Two activity kinds conformed and unioned."""
    prepare(spark)
    return finalize(fact_activity(spark, sf))


# --- marts --------------------------------------------------------------------

@query("rep_scorecard")
def q_rep_scorecard(spark, sf):
    """A1, the flagship: change feed -> latest per key -> active facts -> per-owner scorecard."""
    prepare(spark)
    return marts.rep_scorecard(fact_opportunity(spark, sf))


@query("stale_deals")
def q_stale_deals(spark, sf):
    """F7 at a fixed clock."""
    prepare(spark)
    return finalize(marts.stale_deals(fact_opportunity(spark, sf), AS_OF_SALES).select(
        "opportunity_id", "owner_id", "modified_ts", "state_code", "estimated_value"))


@query("open_deals_by_stage")
def q_open_by_stage(spark, sf):
    prepare(spark)
    return marts.open_deals_by_stage(fact_opportunity(spark, sf))


@query("win_rate")
def q_win_rate(spark, sf):
    prepare(spark)
    return marts.win_rate(fact_opportunity(spark, sf))


@query("quote_trend")
def q_quote_trend(spark, sf):
    prepare(spark)
    return finalize(marts.quote_trend(fact_quote(spark, sf)))


@query("quote_conversion")
def q_quote_conversion(spark, sf):
    prepare(spark)
    return marts.quote_conversion(fact_opportunity(spark, sf), fact_quote(spark, sf), fact_contract(spark, sf))


@query("contract_lifecycle")
def q_contract_lifecycle(spark, sf):
    prepare(spark)
    return finalize(marts.contract_lifecycle(fact_contract(spark, sf), AS_OF_SALES))


@query("executive_kpis")
def q_exec(spark, sf):
    prepare(spark)
    return marts.executive_kpis(fact_opportunity(spark, sf))


@query("funnel_kpis")
def q_funnel(spark, sf):
    prepare(spark)
    return marts.funnel_kpis(fact_opportunity(spark, sf), fact_quote(spark, sf), fact_contract(spark, sf))


@query("activity_kpis")
def q_activity_kpis(spark, sf):
    prepare(spark)
    return marts.activity_kpis(fact_activity(spark, sf))


@query("inactive_opportunities")
def q_inactive(spark, sf):
    prepare(spark)
    return finalize(marts.inactive_opportunities(fact_opportunity(spark, sf), fact_activity(spark, sf), AS_OF_OPS)
                    .select("opportunity_id", "owner_id", "stage_name", "estimated_value"))


@query("weighted_forecast")
def q_forecast(spark, sf):
    prepare(spark)
    return finalize(marts.weighted_forecast(fact_opportunity(spark, sf)))


# --- dimensions and star ------------------------------------------------------

@query("dim_date")
def q_dim_date(spark, sf):
    prepare(spark)
    return dims.dim_date(fact_opportunity(spark, sf), "created_date", "expected_close_date")


@query("dim_sales_owner")
def q_dim_owner(spark, sf):
    prepare(spark)
    return dims.dim_sales_owner(feeds.owner_attributes(spark, sf))


@query("stage_standardisation")
def q_stage_std(spark, sf):
    prepare(spark)
    s = dims.standard_stage(fact_opportunity(spark, sf), fact_quote(spark, sf), fact_activity(spark, sf))
    return s.select("opportunity_id", "state_code", "standard_stage")


@query("dim_stage")
def q_dim_stage(spark, sf):
    prepare(spark)
    return dims.dim_stage(dims.standard_stage(fact_opportunity(spark, sf), fact_quote(spark, sf),
                                              fact_activity(spark, sf)))


@query("dim_activity_type")
def q_dim_activity_type(spark, sf):
    prepare(spark)
    return dims.dim_activity_type(fact_activity(spark, sf))


@query("opportunity_star")
def q_star(spark, sf):
    prepare(spark)
    return dims.opportunity_star(fact_opportunity(spark, sf), fact_quote(spark, sf), fact_activity(spark, sf),
                                 feeds.owner_attributes(spark, sf))


@query("last_activity_date")
def q_last_activity(spark, sf):
    prepare(spark)
    return dims.last_activity(fact_activity(spark, sf))


@query("activity_duration")
def q_activity_duration(spark, sf):
    prepare(spark)
    return dims.with_activity_duration(fact_activity(spark, sf)).select(
        "activity_id", "activity_type", "activity_duration_minutes")


@query("activity_opportunity_map")
def q_activity_map(spark, sf):
    prepare(spark)
    return dims.activity_opportunity_map(fact_activity(spark, sf))


# --- change log: bronze, silver state, history ------------------------------



STATE_COLUMNS = ("user_id", "event_id", "modifiedon", "change_operation", "amount", "event_type", "bronze_op_type",
                 "is_active", "silver_deleted_ts", "silver_last_event_ts", "silver_last_run_id", "silver_updated_ts")


def event_bronze(spark, sf) -> DataFrame:
    feed = feeds.event_changes(spark, sf)
    return bronze_rows(feed, EVENT_SPEC, "bronze-events", F.col("batch_ingest_ts"))


def event_valid(spark, sf) -> DataFrame:
    valid, _ = split_valid_invalid(checked(event_bronze(spark, sf), EVENT_SPEC))
    return valid


def event_state(spark, sf, hard: bool = False, where=None) -> DataFrame:
    valid = event_valid(spark, sf)
    if where is not None:
        valid = valid.filter(where)
    return replay_current_state(valid, EVENT_SPEC, "batch_date", "batch_run_id", "batch_ingest_ts",
                                EVENT_TIE_BREAKERS, hard_delete=hard).select(*STATE_COLUMNS)


@query("cdc_classification")
def q_cdc_classification(spark, sf):
    """P1 + P2: change classification and lineage of every change row."""
    prepare(spark)
    return event_bronze(spark, sf).select(
        "event_id", "change_operation", "bronze_op_type", "bronze_is_delete", "bronze_entity_name",
        "bronze_pipeline_run_id", "bronze_source_type", "bronze_write_mode", "bronze_delete_handling")


@query("latest_per_key")
def q_latest_per_key(spark, sf):
    """W1 over the whole change log: latest change per user."""
    prepare(spark)
    return finalize(latest_per_key(event_valid(spark, sf), ["user_id"], ["bronze_business_event_ts",
                                                                        "bronze_ingest_ts", "event_id"])
                    .select("user_id", "event_id", "modifiedon", "bronze_op_type", "amount"))


@query("silver_current_state")
def q_silver_state(spark, sf):
    """M1 over 30 daily batches, computed in one pass (closed-form replay)."""
    prepare(spark)
    return finalize(event_state(spark, sf))


def _run_id_of(b):
    return F.concat(F.lit("silver-"), F.date_format(b, "yyyyMMdd"))


def _run_ts_of(b):
    return F.date_add(b, 1).cast("timestamp")


@query("silver_incremental_merge")
def q_silver_incremental(spark, sf):
    """M1 batch after batch as appended changes: the batches before the cut are folded to a base, the later ones read on top of it."""
    prepare(spark)
    table = state_table(spark, scratch_path(spark, "event-state"), EVENT_SPEC)
    valid, cut = event_valid(spark, sf), F.to_date(F.lit(CHANGE_FEED_CUT))
    for part in (F.col("batch_date") < cut, F.col("batch_date") >= cut):
        if table.exists():
            table.fold()
        append_batches(table, valid.filter(part), EVENT_SPEC, "batch_date", _run_id_of, _run_ts_of, EVENT_TIE_BREAKERS)
    return finalize(table.read().select(*STATE_COLUMNS))


# Gold mapping of the change-log entity (business key user_id).
EVENT_GOLD = EVENT_SPEC.with_(business_key="user_id", column_mapping=(
    ("user_id", "user_id"), ("event_id", "event_id"), ("event_type", "event_type"), ("amount", "amount"),
    ("modified_ts", "modifiedon")))
GOLD_COLUMNS = ("user_id", "event_id", "event_type", "amount", "modified_ts", "is_active", "source_event_ts",
                "source_run_id", "gold_source_updated_ts")


@query("gold_incremental_merge")
def q_gold_incremental(spark, sf):
    """F2 + M2: gold built from the silver state before the cut, then merged with
    the silver rows updated after it (deletes leave gold); equals the active rows."""
    prepare(spark)
    from revflow.operators.facts import build_fact_rows
    from revflow.operators.merge import merge_fact

    cut = F.to_date(F.lit(CHANGE_FEED_CUT))
    old = replay_current_state(event_valid(spark, sf).filter(F.col("batch_date") < cut), EVENT_SPEC, "batch_date",
                               "batch_run_id", "batch_ingest_ts", EVENT_TIE_BREAKERS)
    new = replay_current_state(event_valid(spark, sf), EVENT_SPEC, "batch_date", "batch_run_id", "batch_ingest_ts",
                               EVENT_TIE_BREAKERS)
    gold_ts = _ts(AS_OF_OPS)
    first = build_fact_rows(old, EVENT_GOLD, gold_ts)
    gold = merge_fact(first.drop("gold_delete_flag").limit(0), first, "user_id")
    watermark = old.agg(F.max("silver_updated_ts")).scalar()  # A3, a subquery of the same plan
    increment = new.filter(F.col("silver_updated_ts") > watermark)  # F2, strict
    gold = merge_fact(gold, build_fact_rows(increment, EVENT_GOLD, gold_ts), "user_id")
    return finalize(gold.select(*GOLD_COLUMNS))


@query("silver_hard_delete")
def q_silver_hard(spark, sf):
    """The hard-delete strategy (a delete removes the row)."""
    prepare(spark)
    return finalize(event_state(spark, sf, hard=True))


BACKFILL = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")


@query("silver_backfill")
def q_silver_backfill(spark, sf):
    """Only changes ingested inside the backfill window [from, to)."""
    prepare(spark)
    window = silver_increment(event_bronze(spark, sf), backfill=BACKFILL)
    valid, _ = split_valid_invalid(checked(window, EVENT_SPEC))
    return finalize(replay_current_state(valid, EVENT_SPEC, "batch_date", "batch_run_id", "batch_ingest_ts",
                                         EVENT_TIE_BREAKERS).select(*STATE_COLUMNS))


CHANGE_FEED_CUT = "2024-01-16"
#: A mark after every run.
FOREVER = (1 << 63) - 1


@query("change_feed")
def q_change_feed(spark, sf):
    """Inserts, updates and deletes between the state before the cut and the final state."""
    prepare(spark)
    old = event_state(spark, sf, where=F.col("batch_date") < F.to_date(F.lit(CHANGE_FEED_CUT)))
    new = event_state(spark, sf)
    return table_diff(old, new, ["user_id"], ["event_id", "is_active", "silver_deleted_ts"],
                      carry=["event_id", "is_active"])


@query("change_feed_of_runs")
def q_change_feed_of_runs(spark, sf):
    """X29 from what was written: the runs from the cut on, over the base of the runs before; the same rows as the two states' difference."""
    prepare(spark)
    table = state_table(spark, scratch_path(spark, "event-feed"), EVENT_SPEC)
    valid, cut = event_valid(spark, sf), F.to_date(F.lit(CHANGE_FEED_CUT))
    append_batches(table, valid.filter(F.col("batch_date") < cut), EVENT_SPEC, "batch_date", _run_id_of, _run_ts_of, EVENT_TIE_BREAKERS)
    after = table.fold()
    append_batches(table, valid.filter(F.col("batch_date") >= cut), EVENT_SPEC, "batch_date", _run_id_of, _run_ts_of, EVENT_TIE_BREAKERS)
    return fold_feed(table.changes_at(after or 0), EVENT_SPEC, after or 0, FOREVER, ["event_id", "is_active", "silver_deleted_ts"], carry=["event_id", "is_active"])


@query("stage_movement")
def q_stage_movement(spark, sf):
    """Each user's daily state (stage = event type) against the day before."""
    prepare(spark)
    valid = event_valid(spark, sf).filter(~F.col("bronze_is_delete"))
    daily = latest_per_key(valid, ["user_id", "batch_date"], ["bronze_business_event_ts", "event_id"])
    snaps = daily.select("user_id", F.col("batch_date").alias("snapshot_date"),
                         F.col("event_type").alias("stage_name"), F.col("amount").alias("estimated_value"))
    return marts.stage_movement(snaps, "user_id", "snapshot_date")


# --- data quality and quarantine ----------------------------------------------


CUSTOMER_SPEC = EntitySpec(name="customer", primary_key="c_custkey",
                           mandatory_columns=("c_custkey", "segment"), non_negative_columns=("c_acctbal",))


def customer_checked(spark, sf, mandatory=CUSTOMER_SPEC.mandatory_columns) -> DataFrame:
    df = feeds.customer_feed(spark, sf)
    return dq.apply_non_negative_checks(dq.apply_mandatory_checks(df, mandatory), CUSTOMER_SPEC.non_negative_columns)


def customer_bad_records(spark, sf) -> DataFrame:
    _, invalid = dq.split_valid_invalid(customer_checked(spark, sf))
    return dq.build_bad_records(invalid, "dq-customer", "customer", "silver", "c_custkey", _ts(AS_OF_OPS))


@query("dq_reasons")
def q_dq_reasons(spark, sf):
    """Mandatory (NULL, blank, absent column) and non-negative reasons per row."""
    prepare(spark)
    df = customer_checked(spark, sf, ("c_custkey", "segment", "c_phone"))
    return df.select("c_custkey", F.concat_ws("|", dq.REASONS).alias("reasons"),
                     F.size(dq.REASONS).cast("long").alias("reason_count"))


@query("dq_split")
def q_dq_split(spark, sf):
    """valid + invalid = input."""
    prepare(spark)
    return dq.split_counts(customer_checked(spark, sf))


@query("bad_records")
def q_bad_records(spark, sf):
    """The quarantine envelope of the invalid rows (id and JSON payload left out of the comparison)."""
    prepare(spark)
    return finalize(customer_bad_records(spark, sf).drop("quarantine_id", "raw_record"))


@query("quarantine_summary")
def q_quarantine_summary(spark, sf):
    """A2 over the quarantined rows."""
    prepare(spark)
    return finalize(ops_views.quarantine_summary(customer_bad_records(spark, sf)))


@query("dq_positive_amount")
def q_dq_positive(spark, sf):
    """Balances must be strictly positive."""
    prepare(spark)
    df = feeds.customer_feed(spark, sf)
    df = dq.add_reasons(df, [dq.positive_rule(df, "c_acctbal")])
    _, bad = dq.split_valid_invalid(df)
    return bad.select("c_custkey", F.concat_ws("|", dq.REASONS).alias("reasons"))


@query("dq_date_order")
def q_dq_date_order(spark, sf):
    """X11: a line may not ship before its order date."""
    prepare(spark)
    li = feeds.table(spark, sf, "lineitem").select(feeds.quote_key().alias("quoteid"), "l_orderkey", "l_shipdate")
    o = feeds.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    df = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    df = dq.add_reasons(df, [dq.date_order_rule(df, "o_orderdate", "l_shipdate")])
    _, bad = dq.split_valid_invalid(df)
    return bad.select("quoteid", "l_shipdate", "o_orderdate", F.concat_ws("|", dq.REASONS).alias("reasons"))


@query("dq_owner_mandatory")
def q_dq_owner(spark, sf):
    """Owner id is mandatory on opportunities."""
    prepare(spark)
    return dq.split_counts(dq.apply_mandatory_checks(feeds.opportunity_feed(spark, sf), ["ownerid", "opportunityid"]))


@query("dq_duplicate_keys")
def q_dq_duplicates(spark, sf):
    """Every copy of a repeated quote key is flagged."""
    prepare(spark)
    df = dq.with_duplicate_key_reason(feeds.quote_changes(spark, sf), ["quoteid"])
    _, bad = dq.split_valid_invalid(df)
    return bad.groupBy("quoteid").agg(F.count(F.lit(1)).alias("copies"),
                                      F.first(F.concat_ws("|", dq.REASONS)).alias("reasons"))


@query("dq_timeliness")
def q_dq_timeliness(spark, sf):
    """Changes that landed more than 12 hours after they happened."""
    prepare(spark)
    df = event_bronze(spark, sf)
    df = dq.add_reasons(df, [dq.timeliness_rule("modifiedon", "bronze_ingest_ts", 12 * 3600)])
    _, bad = dq.split_valid_invalid(df)
    return bad.select("event_id", "user_id", F.concat_ws("|", dq.REASONS).alias("reasons"))


PART_DECLARED = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_size", T.IntegerType()),
    T.StructField("p_retailprice", T.DecimalType(12, 2)), T.StructField("p_brand", T.IntegerType()),
    T.StructField("p_container", T.StringType()),
])


@query("type_conformance")
def q_type_conformance(spark, sf):
    """A string-typed feed cast to its declared schema; failed casts become BAD_TYPE reasons."""
    prepare(spark)
    raw = feeds.table(spark, sf, "part").select(*[F.col(c).cast("string").alias(c) for c in
                                                  ("p_partkey", "p_size", "p_retailprice", "p_brand")])
    df = dq.conform_types(raw, PART_DECLARED)
    return df.select("p_partkey", "p_size", F.col("p_retailprice").cast("double").alias("p_retailprice"),
                     "p_brand", "p_container", F.concat_ws("|", dq.REASONS).alias("reasons"))


# --- snapshots ----------------------------------------------------------------

SNAPSHOT_COLUMNS = ("opportunity_id", "snapshot_ts", "snapshot_date", "snapshot_hour", "snapshot_grain",
                    "snapshot_run_id", "days_open", "days_to_expected_close", "pipeline_age_bucket")


def opportunity_snapshot(spark, sf) -> DataFrame:
    """The daily snapshot stored by date, then the same snapshot run again (M4):
    the rerun overwrites the stored date's partition with the same rows."""
    fact = fact_opportunity(spark, sf)
    snap = build_snapshot(fact, AS_OF_SALES, "snapshot-20010801", OPPORTUNITY, _ts(AS_OF_SALES))
    path = scratch_path(spark, "snapshots")
    snap = snap.persist()  # one snapshot, stored and then rerun
    try:
        for _ in range(2):
            store_snapshot(path, snap, AS_OF_SALES)
    finally:
        snap.unpersist()
    return stored_snapshots(spark, path)


@query("opportunity_snapshot")
def q_snapshot(spark, sf):
    """P13-P16 + M4: the daily snapshot, merged twice (idempotent)."""
    prepare(spark)
    return finalize(opportunity_snapshot(spark, sf).select(*SNAPSHOT_COLUMNS))


@query("snapshot_age_buckets")
def q_age_buckets(spark, sf):
    prepare(spark)
    return opportunity_snapshot(spark, sf).groupBy("pipeline_age_bucket").agg(
        F.count(F.lit(1)).alias("opportunity_count"), marts.money_sum("estimated_value").alias("pipeline_value"))


# --- control tables and ops views -----------------------------------------------

@query("recent_runs")
def q_recent_runs(spark, sf):
    """L1 over the run registry."""
    prepare(spark)
    return ops_views.recent_runs(feeds.run_events(spark, sf))


@query("failed_runs")
def q_failed_runs(spark, sf):
    """F8 + L2."""
    prepare(spark)
    return ops_views.failed_runs(feeds.run_events(spark, sf))


@query("layer_freshness")
def q_layer_freshness(spark, sf):
    """F9 + W2 at a fixed clock."""
    prepare(spark)
    return ops_views.layer_freshness(feeds.run_events(spark, sf), AS_OF_OPS)


@query("health_summary")
def q_health(spark, sf):
    """W3 at a fixed clock."""
    prepare(spark)
    return ops_views.health_summary(feeds.run_events(spark, sf), AS_OF_OPS)


@query("current_watermarks")
def q_current_watermarks(spark, sf):
    """M5 + F10: exactly one current watermark per (entity, layer)."""
    prepare(spark)
    return control.current_watermarks(feeds.watermark_events(spark, sf))


@query("stale_watermarks")
def q_stale_watermarks(spark, sf):
    """O1 at two clocks: 30-minute layer rule and the 26-hour snapshot rule."""
    prepare(spark)
    from revflow.plans.oracle_sql import AS_OF_OPS_LATE

    wm = control.current_watermarks(feeds.watermark_events(spark, sf))
    return finalize(ops_views.stale_watermarks_at(wm, [AS_OF_OPS, AS_OF_OPS_LATE]))


@query("run_registry_fold")
def q_run_fold(spark, sf):
    """M6 + M7: start and end events per run folded into the registry."""
    prepare(spark)
    runs = feeds.run_events(spark, sf)
    types = {f.name: f.dataType for f in runs.schema.fields}
    start = [F.col(c) if c in ("run_id", "parent_run_id", "pipeline_name", "entity_name", "layer_name",
                                "trigger_type", "attempt_no", "run_start_ts", "created_ts")
             else (F.lit("running") if c == "status" else
                   F.lit(0).cast("long") if c == "rows_quarantined" else
                   F.col("run_start_ts") if c == "updated_ts" else
                   F.lit(None)).cast(types[c]).alias(c) for c in runs.columns]
    end = [F.col(c) if c in ("run_id", "run_end_ts", "status", "source_high_watermark", "source_row_count",
                              "target_row_count", "rows_quarantined", "error_message")
           else (F.col("run_end_ts") if c == "updated_ts" else F.lit(None)).cast(types[c]).alias(c)
           for c in runs.columns]
    # one scan: each run row yields its start and its end event (a generator, no second read)
    events = runs.select(F.explode(F.array(F.struct(*start), F.struct(*end))).alias("__e")).select("__e.*")
    return control.fold_runs(events)


@query("run_metrics")
def q_run_metrics(spark, sf):
    """Runs, success rate, rows and mean runtime per (entity, layer)."""
    prepare(spark)
    return ops_views.run_metrics(feeds.run_events(spark, sf))


# --- streaming ----------------------------------------------------------------


EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


@query("bronze_stream")
def q_bronze_stream(spark, sf):
    """The change file streamed into a bronze table
    partitioned by ingestion date; a second availableNow run adds nothing."""
    prepare(spark)
    base = scratch_path(spark, "bronze-stream")
    raw = read_feed_stream(spark, sf, EVENT_SCHEMA, glob="events.parquet")
    bronze = bronze_stream(feeds.event_changes_of(raw), EVENT_SPEC, "bronze-stream", _ts(AS_OF_OPS))
    for _ in range(2):
        run_bronze_available_now(bronze, f"{base}/table", f"{base}/_checkpoint")
    out = spark.read.parquet(f"{base}/table")
    return out.select("event_id", "user_id", "change_operation", "bronze_op_type", "bronze_is_delete",
                      "bronze_entity_name", "bronze_pipeline_run_id", "ingestion_date",
                      F.element_at(F.split("bronze_source_file_path", "/"), -1).alias("source_file_name"))


STREAM_CUT = "2024-01-16"


@query("cdc_stream_state")
def q_cdc_stream(spark, sf):
    """T5: two file drops streamed through foreachBatch (dedup + M1 as appended
    changes, folded on read); each drop is one micro-batch."""
    prepare(spark)
    base = scratch_path(spark, "cdc-stream")
    landing = f"{base}/landing"
    events = feeds.table(spark, sf, "events")
    cut = F.to_timestamp(F.lit(STREAM_CUT))
    state = state_table(spark, f"{base}/state", EVENT_SPEC)
    writer = CurrentStateWriter(state, EVENT_SPEC, lambda b: f"stream-{b}", f"{base}/quarantine", _ts(AS_OF_OPS), EVENT_TIE_BREAKERS)
    for drop in (events.filter(F.col("ts") < cut), events.filter(F.col("ts") >= cut)):
        drop.write.mode("append").parquet(landing)
        raw = read_feed_stream(spark, landing, EVENT_SCHEMA)
        bronze = bronze_stream(feeds.event_changes_of(raw), EVENT_SPEC, "bronze-stream", _ts(AS_OF_OPS))
        start_current_state_stream(bronze, writer, f"{base}/_checkpoint").awaitTermination()
    return finalize(state.read().select(*STATE_COLUMNS))


@query("compacted_fact")
def q_compacted(spark, sf):
    """A fragmented fact table rewritten as fewer key-clustered files, same content."""
    prepare(spark)
    base = scratch_path(spark, "compaction")
    fact = fact_opportunity(spark, sf).select("opportunity_id", "owner_id", "state_code", "estimated_value",
                                             "created_date")
    rows_per_file = 50_000
    # fragments of at most half a target file, so their number grows with the rows as the compacted files do
    tasks = max(32, int(spark.conf.get("spark.sql.shuffle.partitions")))
    fact.repartition(tasks).write.option("maxRecordsPerFile", rows_per_file // 2).parquet(f"{base}/v0")
    before = file_count(spark.read.parquet(f"{base}/v0"))
    out = compact(spark, f"{base}/v0", f"{base}/v1", ["opportunity_id"], rows_per_file=rows_per_file)
    if file_count(out) > before:
        raise RuntimeError("compaction produced more files than it read")
    return out


# --- formats, schema evolution and the job chain -------------------------------


FEED_COLUMNS = ("opportunityid", "name", "ownerid", "createdon", "estimatedclosedate", "estimatedvalue",
                "closeprobability", "statecode", "stepname")


@query("feed_formats")
def q_feed_formats(spark, sf):
    """The feed landed as JSON and CSV in two drops, the second with an
    added column; the merged schema is discovered and every drop read with it."""
    prepare(spark)
    base = scratch_path(spark, "formats")
    feed = feeds.opportunity_feed(spark, sf).select(*FEED_COLUMNS)
    late = F.col("createdon") >= F.to_timestamp(F.lit("1998-01-01 00:00:00"))
    first = feed.filter(~late)
    second = feed.filter(late).withColumn("channel", F.col("stepname"))  # additive column
    schema = T.StructType([*feed.schema.fields, T.StructField("channel", T.StringType())])
    out = None
    for fmt in ("json", "csv"):
        path = f"{base}/{fmt}"
        for drop in (first, second):
            w = drop.write.mode("append").format(fmt)
            (w.option("header", "true") if fmt == "csv" else w).save(path)
        if fmt == "json":
            discovered = infer_feed_schema(spark, path, "json")
            assert "channel" in discovered.fieldNames()
        rows = read_feed(spark, path, schema, fmt).withColumn("format", F.lit(fmt))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("medallion_jobs_fact")
def q_jobs_fact(spark, sf):
    """The opportunity feed in two file drops through the
    bronze stream, silver and gold jobs (watermarks, run registry); the gold fact's business columns."""
    prepare(spark)
    from revflow import jobs

    base = scratch_path(spark, "jobs")
    ws = jobs.Workspace(spark, f"{base}/ws")
    landing = f"{base}/landing"
    feed = feeds.opportunity_feed(spark, sf)
    late = F.col("createdon") >= F.to_timestamp(F.lit("1998-01-01 00:00:00"))
    for i, drop in enumerate((feed.filter(~late), feed.filter(late))):
        now = datetime(2024, 1, 1, 1 + i)
        drop.write.mode("append").parquet(landing)
        jobs.run_bronze(ws, OPPORTUNITY, landing, feed.schema, f"bronze-{i}", now=now)
        jobs.run_silver(ws, OPPORTUNITY, f"silver-{i}", now=now)
        jobs.run_gold(ws, OPPORTUNITY, f"gold-{i}", now=now)
    return finalize(ws.gold("fact_opportunity").read().select(
        "opportunity_id", "opportunity_name", "owner_id", "created_ts", "expected_close_date", "estimated_value",
        "probability", "state_code", "stage_name", "weighted_amount", "expected_close_month", "is_active"))


LATE_DAYS = 3


@query("silver_late_data")
def q_silver_late(spark, sf):
    """T4: changes with a small amount land three days late; merged batch by batch
    with the time guard, an older change never overwrites a newer state."""
    prepare(spark)
    valid = event_valid(spark, sf)
    arrival = F.when(F.col("amount") < 5.0, F.date_add("batch_date", LATE_DAYS)).otherwise(F.col("batch_date"))
    late = valid.withColumn("batch_date", arrival).withColumn(
        "bronze_ingest_ts", F.date_add("batch_date", 1).cast("timestamp"))
    table = state_table(spark, scratch_path(spark, "late-events"), EVENT_SPEC, time_guard=True)
    append_batches(table, late, EVENT_SPEC, "batch_date", _run_id_of, _run_ts_of, EVENT_TIE_BREAKERS)
    return finalize(table.read().select(*STATE_COLUMNS))


# --- schema evolution, incremental activities, stored snapshots, clustering ---------------------

DECLARED = T.StructType([
    T.StructField("opportunityid", T.LongType()), T.StructField("ownerid", T.LongType()), T.StructField("modifiedon", T.TimestampType()),
    T.StructField("estimatedvalue", T.DoubleType()), T.StructField("change_operation", T.StringType()),
])


def evolving_drops(spark, sf) -> list[DataFrame]:
    """Three drops of the opportunity feed as JSON: the second adds a column, the third widens one and has values that clash."""
    feed = feeds.opportunity_feed(spark, sf).select("opportunityid", "ownerid", "modifiedon", "estimatedvalue", "change_operation")
    rank = F.col("opportunityid") % 10
    drops = []
    for i in range(3):
        drop = feed.filter(F.col("opportunityid") % 3 == i).withColumn("priority", rank if i < 2 else rank + F.lit(0.5))
        drop = drop if i == 0 else drop.withColumn("channel", F.concat(F.lit("c"), rank.cast("string")))
        if i == 2:
            drop = drop.withColumn("estimatedvalue", F.when(rank == 4, F.lit("n/a")).otherwise(F.col("estimatedvalue").cast("string")))
        drops.append(drop)
    return drops


@query("schema_evolution")
def q_schema_evolution(spark, sf):
    """Three JSON drops whose schema grows; each run discovers it, restarts the stream with it, and nothing is lost."""
    prepare(spark)
    from revflow import jobs

    base = scratch_path(spark, "evolution")
    ws = jobs.Workspace(spark, f"{base}/ws", {"opportunity": DECLARED})
    for i, drop in enumerate(evolving_drops(spark, sf)):
        drop.write.mode("append").json(f"{base}/landing")
        jobs.run_bronze(ws, OPPORTUNITY, f"{base}/landing", None, f"bronze-{i}", fmt="json")
    return finalize(ws.bronze("opportunity").select(
        "opportunityid", "ownerid", "modifiedon", "estimatedvalue", "change_operation", "priority", "channel",
        F.to_json("_rescued").alias("rescued"), "bronze_pipeline_run_id", "bronze_op_type"))


@query("landed_drift")
def q_landed_drift(spark, sf):
    """What the landed files of the three drops have that the declared schema doesn't."""
    prepare(spark)
    base = scratch_path(spark, "drift")
    for i, drop in enumerate(evolving_drops(spark, sf)):
        drop.coalesce(1).write.json(f"{base}/drop={i}")
    lines = spark.read.text(base).select("value", F.col("_metadata.file_path").alias("file"), F.to_timestamp(
        F.concat(F.lit("2024-01-0"), (F.col("drop") + 1).cast("string"))).alias("landed"))
    found = ops_views.landed_drift(lines, T.StructType([f for f in DECLARED.fields if f.name != "modifiedon"]))
    return finalize(found.select("column_name", "change", "expected_type", "actual_type", "files", "first_landed"))


@query("activity_incremental")
def q_activity_incremental(spark, sf):
    """Both activity kinds in two increments (new rows, then updates and deletes of either kind), one merge with a mark each."""
    prepare(spark)
    from revflow import jobs
    from revflow.plans.medallion import silver_source

    ws = jobs.Workspace(spark, scratch_path(spark, "activity"))
    key = F.col("activityid")
    for i in range(2):
        now = datetime(2024, 1, 1, 1 + i)
        for spec in (PHONECALL, APPOINTMENT):
            feed = feeds.activity_feed(spark, sf, spec.name)
            if i == 1:  # a seventh of both kinds is deleted, a fifth of the calls reopened
                feed = feed.filter((key % 7 == 0) | ((key % 5 == 0) & F.lit(spec is PHONECALL))).withColumns({
                    "change_operation": F.when(key % 7 == 0, "D").otherwise("U"), "statuscode": F.lit("Reopened"),
                    "modifiedon": F.col("modifiedon") + F.expr("INTERVAL 1 DAY")})
            run_ts = F.lit(now).cast("timestamp")
            changes, _ = silver_source(bronze_rows(feed, spec, f"b{i}", run_ts), spec, f"s{i}", run_ts)
            ws.silver(spec.name).append(changes, f"s{i}", jobs.micros(now))
        jobs.run_activity(ws, f"a{i}", now)
    return dims.silver_activity(ws.gold("fact_activity").read())


SNAPSHOT_DATES = ("2024-01-05", "2024-01-10", "2024-01-15", "2024-01-20", "2024-01-25")


def stored_event_snapshots(spark, sf) -> tuple[DataFrame, str]:
    """The active rows of the event state on several dates, stored by date, and each date's movement; the last date is run twice."""
    base = scratch_path(spark, "stage-snapshots")
    for day in (*SNAPSHOT_DATES, SNAPSHOT_DATES[-1]):
        state = event_state(spark, sf, where=F.col("batch_date") <= F.to_date(F.lit(day))).filter("is_active")
        snap = state.select("user_id", F.col("event_type").alias("stage_name"), F.col("amount").alias("estimated_value"),
                            F.to_date(F.lit(day)).alias("snapshot_date"))
        snap.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(f"{base}/snapshots")
        store_movement(spark, stored_snapshots(spark, f"{base}/snapshots"), f"{base}/movement", day, "user_id")
    return stored_snapshots(spark, f"{base}/snapshots"), base


@query("snapshot_movement")
def q_snapshot_movement(spark, sf):
    """X25 on stored snapshots: each date read against the states carried from the date before."""
    prepare(spark)
    _, base = stored_event_snapshots(spark, sf)
    return stored_snapshots(spark, f"{base}/movement/moved")


@query("pipeline_trend")
def q_pipeline_trend(spark, sf):
    """Rows and value of each stage over the stored dates of one stretch of the calendar (dynamic partition pruning)."""
    prepare(spark)
    snaps, _ = stored_event_snapshots(spark, sf)
    calendar = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-12-31')) AS snapshot_date")
    return pipeline_trend(snaps, calendar.filter(F.dayofmonth("snapshot_date").between(8, 22)))


@query("z_ordered_fact")
def q_z_ordered(spark, sf):
    """The opportunity fact compacted on two columns alike (Z-order): the same rows."""
    prepare(spark)
    base = scratch_path(spark, "z-order")
    fact = fact_opportunity(spark, sf).select("opportunity_id", "owner_id", "state_code", "estimated_value", "created_date")
    fact.repartition(16).write.parquet(f"{base}/v0")
    return compact(spark, f"{base}/v0", f"{base}/v1", ["owner_id", "created_date"], rows_per_file=2_000, z_order=True)
