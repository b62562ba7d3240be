"""CRM change-feed shapes derived from the supplied TPC-H-like tables.

Every feed is a projection of the input tables (no synthetic rows), so its
size grows with the data. The DuckDB oracle applies the same mapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revflow.operators.dedup import latest_per_key

# Event type -> change operation of the event change log
# (view is deliberately unmapped and classifies as UNKNOWN).
EVENT_OPERATIONS = {"signup": "I", "purchase": "U", "click": "U", "error": "D", "view": "X"}
# Order priority -> close probability (percent).
PRIORITY_PROBABILITY = {"1-URGENT": 90.0, "2-HIGH": 70.0, "3-MEDIUM": 50.0, "4-NOT SPECIFIED": 30.0, "5-LOW": 10.0}
# Order status -> opportunity state.
ORDER_STATE = {"O": "Open", "F": "Won", "P": "Lost"}
# Run-registry fixture (entity by user_id % 6, layer by floor(user_id / 6) % 4,
# status by event type).
RUN_ENTITIES = ("opportunity", "quote", "contract", "phonecall", "appointment", "pipeline_item")
RUN_LAYERS = ("bronze", "silver", "gold", "gold_snapshot")
RUN_STATUS = {"error": "failed", "view": "partial_success", "signup": "skipped", "click": "success",
              "purchase": "success"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: str, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(F.col(col) == F.lit(k), F.lit(v)) if expr is None else expr.when(F.col(col) == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log keyed by ``user_id``; one daily batch per ``date(ts)``.

    A batch lands at the midnight after its day (``bronze_ingest_ts``) and is
    merged by run ``silver-<yyyymmdd>`` at that time.
    """
    return event_changes_of(table(spark, sf_dir, "events"))


def event_changes_of(ev: DataFrame) -> DataFrame:
    """The change-log projection of any events frame (batch or stream)."""
    batch = F.to_date("ts")
    landed = F.date_add(batch, 1).cast("timestamp")
    return ev.select(
        "event_id", "user_id", F.col("ts").alias("modifiedon"),
        _case("event_type", EVENT_OPERATIONS).alias("change_operation"),
        F.col("value").alias("amount"), "event_type",
        batch.alias("batch_date"),
        landed.alias("batch_ingest_ts"),
        F.concat(F.lit("silver-"), F.date_format(batch, "yyyyMMdd")).alias("batch_run_id"),
    )


def opportunity_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("opportunityid"),
        F.concat(F.lit("OPP-"), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_custkey").alias("ownerid"),
        F.col("o_custkey").alias("customerid"),
        F.col("o_orderdate").alias("createdon"),
        F.date_add(F.to_date("o_orderdate"), 60).alias("estimatedclosedate"),
        F.col("o_totalprice").alias("estimatedvalue"),
        _case("o_orderpriority", PRIORITY_PROBABILITY).cast("double").alias("closeprobability"),
        F.col("o_orderstatus").alias("statuscode"),
        _case("o_orderstatus", ORDER_STATE).alias("statecode"),
        F.col("o_orderpriority").alias("stepname"),
        F.col("o_orderdate").alias("modifiedon"),
        F.lit("I").alias("change_operation"),
    )


def quote_key():
    return (F.col("l_orderkey") * F.lit(10) + F.col("l_linenumber")).cast("long")


# Tie-breakers after the event time for the quote feed (unique within a key).
QUOTE_TIE_BREAKERS = ("l_extendedprice", "l_partkey", "l_suppkey")


def quote_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem row is one quote change; keys repeat (the dedup input)."""
    li = table(spark, sf_dir, "lineitem")
    q = quote_key()
    return li.select(
        q.alias("quoteid"),
        F.col("l_orderkey").alias("opportunityid"),
        F.concat(F.lit("Q-"), q.cast("string")).alias("name"),
        q.cast("string").alias("quotenumber"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("totalamount"),
        F.col("l_shipdate").alias("createdon"),
        F.col("l_shipdate").alias("modifiedon"),
        F.col("l_returnflag").alias("statuscode"),
        F.col("l_linestatus").alias("statecode"),
        F.lit("I").alias("change_operation"),
        *QUOTE_TIE_BREAKERS,
    )


def quote_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated quotes: latest change per key (ship date, then tie-breakers)."""
    return latest_per_key(quote_changes(spark, sf_dir), ["quoteid"], ["modifiedon", *QUOTE_TIE_BREAKERS])


def contract_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quote_feed(spark, sf_dir).filter(F.col("statuscode") == F.lit("N"))
    return q.select(
        F.col("quoteid").alias("contractid"),
        "opportunityid",
        "quoteid",
        F.concat(F.lit("C-"), F.col("quoteid").cast("string")).alias("title"),
        F.col("totalamount").alias("totalprice"),
        F.col("createdon").alias("activeon"),
        (F.col("createdon") + F.expr("INTERVAL 365 DAYS")).alias("expireson"),
        "createdon",
        "modifiedon",
        F.lit("Active").alias("statuscode"),
        F.col("statecode"),
        F.lit("I").alias("change_operation"),
    )


def activity_feed(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """phonecall = click events, appointment = view events."""
    ev_type = {"phonecall": "click", "appointment": "view"}[kind]
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == F.lit(ev_type))
    end = F.col("ts") + F.expr("INTERVAL 30 MINUTES")
    return ev.select(
        F.col("event_id").alias("activityid"),
        F.col("event_id").alias("regardingobjectid"),
        F.col("user_id").alias("ownerid"),
        F.concat(F.lit(kind + " "), F.col("event_id").cast("string")).alias("subject"),
        F.col("ts").alias("scheduledstart"),
        end.alias("scheduledend"),
        (end if kind == "phonecall" else F.lit(None).cast("timestamp_ntz")).alias("actualend"),
        F.col("ts").alias("createdon"),
        F.col("ts").alias("modifiedon"),
        F.lit("Completed" if kind == "phonecall" else "Scheduled").alias("statuscode"),
        F.lit("Closed" if kind == "phonecall" else "Open").alias("statecode"),
        F.lit("I").alias("change_operation"),
    )


def owner_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation and region are fixed-size reference tables (25 and 5 rows)
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
             .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey, "left")
             .select(F.col("c_custkey").alias("owner_id"), F.col("c_name").alias("owner_name"),
                     F.col("r_name").alias("region"), F.col("c_mktsegment").alias("department")))


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an incomplete segment: NULL for BUILDING, blank for HOUSEHOLD."""
    c = table(spark, sf_dir, "customer")
    seg = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string"))
            .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(" ")).otherwise(F.col("c_mktsegment")))
    return c.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", seg.alias("segment"))


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run registry rows derived from ``events`` (one run per event)."""
    ev = table(spark, sf_dir, "events")
    ent = F.element_at(F.array(*[F.lit(x) for x in RUN_ENTITIES]), (F.pmod(F.col("user_id"), F.lit(6)) + 1).cast("int"))
    lay = F.element_at(F.array(*[F.lit(x) for x in RUN_LAYERS]),
                       (F.pmod(F.floor(F.col("user_id") / 6), F.lit(4)) + 1).cast("int"))
    status = _case("event_type", RUN_STATUS)
    secs = F.floor(F.col("value")).cast("long")
    return ev.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.lit(None).cast("string").alias("parent_run_id"),
        F.concat(F.lit("crm_"), lay, F.lit("_"), ent).alias("pipeline_name"),
        ent.alias("entity_name"),
        lay.alias("layer_name"),
        F.lit("scheduled").alias("trigger_type"),
        F.lit(1).alias("attempt_no"),
        F.col("ts").alias("run_start_ts"),
        (F.col("ts") + F.make_dt_interval(secs=secs)).alias("run_end_ts"),
        status.alias("status"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("source_high_watermark"),
        secs.alias("source_row_count"),
        F.when(status == F.lit("failed"), F.lit(0).cast("long")).otherwise(secs).alias("target_row_count"),
        F.when(status == F.lit("partial_success"), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")).alias(
            "rows_quarantined"),
        F.when(status == F.lit("failed"), F.concat(F.lit("error in run "), F.col("event_id").cast("string"))).alias(
            "error_message"),
        F.col("ts").alias("created_ts"),
        F.col("ts").alias("updated_ts"),
    )


def watermark_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermark updates: one per run, keyed by (entity, layer); current = latest."""
    r = run_events(spark, sf_dir)
    return r.select(
        "entity_name", "layer_name",
        F.lit("source_high_watermark").alias("watermark_type"),
        F.col("source_high_watermark").alias("watermark_value"),
        "run_id",
        F.lit(True).alias("is_current"),
        "updated_ts",
    )
