"""Conformed dimensions and the opportunity star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revflow.functions.columns import activity_duration_minutes

# The standard stages, in funnel order.
STAGES = ("Open", "In Progress", "Quoted", "Won", "Lost", "Closed")
STAGE_ORDER = {s: i + 1 for i, s in enumerate(STAGES)}


def date_key(c: Column) -> Column:
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def dim_date(dates: DataFrame, *columns: str) -> DataFrame:
    """One row per day between the smallest and the largest date of ``columns``.

    The only driver-free way to densify a range: a one-row min/max aggregate over
    all the columns in one pass, exploded with ``sequence`` (the range is days,
    bounded by the calendar).
    """
    days = [F.col(c).cast("date") for c in columns]
    rng = dates.agg(F.array_min(F.array(*(F.min(d) for d in days))).alias("lo"),
                    F.array_max(F.array(*(F.max(d) for d in days))).alias("hi"))
    d = rng.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return d.select(
        date_key(F.col("date")).alias("date_key"), "date",
        F.month("date").alias("month"), F.quarter("date").alias("quarter"), F.year("date").alias("year"),
        (F.weekday("date") + 1).alias("weekday"),  # ISO: 1 = Monday
    )


def dim_sales_owner(owners: DataFrame) -> DataFrame:
    """Owners with region and department; the owner id is its own surrogate key."""
    return owners.select(F.col("owner_id").alias("owner_key"), "owner_id", "owner_name", "region", "department")


def standard_stage(fact_opportunity: DataFrame, fact_quote: DataFrame, fact_activity: DataFrame,
                   keep_last_activity: bool = False) -> DataFrame:
    """Won / Lost / Closed from the state; open deals are Quoted when a quote
    exists, In Progress when an activity exists, else Open.

    The quote and activity sides are reduced to one row per opportunity id
    (map-side) before the left joins. The activity side is the X7 aggregate,
    so ``keep_last_activity`` also returns ``last_activity_date`` from the same
    pass instead of a second read of the activity fact.
    """
    q = fact_quote.select("opportunity_id").distinct().withColumn("__has_quote", F.lit(True))
    if keep_last_activity:
        a = last_activity(fact_activity)
    else:
        a = fact_activity.select("opportunity_id").filter(F.col("opportunity_id").isNotNull()).distinct()
    a = a.withColumn("__has_activity", F.lit(True))
    f = fact_opportunity.join(q, "opportunity_id", "left").join(a, "opportunity_id", "left")
    st = F.col("state_code")
    std = (F.when(st == "Won", F.lit("Won")).when(st == "Lost", F.lit("Lost"))
            .when(st.isin("Closed", "Canceled"), F.lit("Closed"))
            .when(F.col("__has_quote"), F.lit("Quoted"))
            .when(F.col("__has_activity"), F.lit("In Progress"))
            .otherwise(F.lit("Open")))
    return f.withColumn("standard_stage", std).drop("__has_quote", "__has_activity")


def stage_order(c: Column) -> Column:
    expr = None
    for s, o in STAGE_ORDER.items():
        expr = F.when(c == s, F.lit(o)) if expr is None else expr.when(c == s, F.lit(o))
    return expr


def dim_stage(staged: DataFrame) -> DataFrame:
    """The standard stages in use, with their funnel order as key."""
    s = staged.select(F.col("standard_stage").alias("stage_name")).distinct()
    return s.select(stage_order(F.col("stage_name")).alias("stage_key"), "stage_name",
                    stage_order(F.col("stage_name")).alias("stage_order"))


def dim_activity_type(fact_activity: DataFrame) -> DataFrame:
    """Distinct activity kinds, keyed by their rank in name order.

    The window has no partition, but it runs after the (map-side) distinct,
    over a handful of kinds.
    """
    t = fact_activity.groupBy("activity_type").agg(F.count(F.lit(1)).alias("activity_count"))
    return t.select(F.dense_rank().over(Window.orderBy("activity_type")).alias("activity_type_key"),
                    "activity_type", "activity_count")


def last_activity(fact_activity: DataFrame) -> DataFrame:
    """Latest activity date per opportunity (partial aggregation)."""
    return (fact_activity.filter(F.col("opportunity_id").isNotNull()).groupBy("opportunity_id")
            .agg(F.to_date(F.max(F.coalesce("actual_end", "created_ts"))).alias("last_activity_date")))


def with_activity_duration(fact_activity: DataFrame) -> DataFrame:
    """Scheduled duration in minutes."""
    return fact_activity.withColumn("activity_duration_minutes", activity_duration_minutes())


def activity_opportunity_map(fact_activity: DataFrame) -> DataFrame:
    """Which activity concerns which opportunity."""
    return fact_activity.filter(F.col("opportunity_id").isNotNull()).select(
        "activity_id", "opportunity_id", "activity_type")


def silver_activity(fact_activity: DataFrame) -> DataFrame:
    """The unified activity table: who did what, when, in which state, for which opportunity."""
    return fact_activity.select(
        "activity_id", "activity_type", F.col("owner_id").alias("activity_owner"),
        F.to_date(F.coalesce("actual_end", "created_ts")).alias("activity_date"), F.col("status_code").alias("activity_status"),
        F.col("opportunity_id").alias("related_opportunity"))


def opportunity_star(fact_opportunity: DataFrame, fact_quote: DataFrame, fact_activity: DataFrame,
                     owners: DataFrame) -> DataFrame:
    """fact_opportunity with owner, stage and date keys and last activity date.

    The stage key is a fixed CASE (six stages, no join); the date key is
    computed from the date (no join); owners and the last-activity aggregate
    grow with the data, so they are plain equi-joins and AQE broadcasts them
    only when their measured size is under the broadcast threshold.
    """
    staged = standard_stage(fact_opportunity, fact_quote, fact_activity, keep_last_activity=True)
    owner = dim_sales_owner(owners).select("owner_id", "owner_key")
    return (staged.join(owner, "owner_id", "left")
            .select(
                F.col("opportunity_id").alias("opportunity_key"), "owner_key",
                stage_order(F.col("standard_stage")).alias("stage_key"),
                date_key(F.col("created_date")).alias("date_key"),
                F.col("estimated_value").alias("amount"), "probability", "weighted_amount",
                "created_date", "expected_close_date", "last_activity_date"))
