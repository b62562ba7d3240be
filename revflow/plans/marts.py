"""Sales marts over the gold facts.

All are declarative DataFrame plans; the clock is an argument (``as_of``).
Aggregates are partial (map-side) before their shuffle; joins are on keys
whose sides are aggregated first so that no side is multiplied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revflow.functions.columns import money_sum

OPEN, WON, LOST = "Open", "Won", "Lost"


def _ts(as_of: str) -> Column:
    return F.to_timestamp(F.lit(as_of))


def rep_scorecard(fact_opportunity: DataFrame) -> DataFrame:
    """A1: per owner, count and value sums over every fact row (no state filter, as coded)."""
    return fact_opportunity.groupBy("owner_id").agg(
        F.count(F.lit(1)).alias("open_opportunity_count"),
        money_sum("estimated_value").alias("open_pipeline_value"),
        money_sum("weighted_amount").alias("weighted_pipeline_value"),
    )


def stale_deals(fact_opportunity: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """facts not modified within ``days`` before ``as_of``."""
    return fact_opportunity.filter(F.col("modified_ts") < _ts(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"))


def open_deals_by_stage(fact_opportunity: DataFrame) -> DataFrame:
    """Open opportunities, pipeline value and weighted value per stage."""
    return (fact_opportunity.filter(F.col("state_code") == OPEN).groupBy("stage_name").agg(
        F.count(F.lit(1)).alias("open_count"),
        money_sum("estimated_value").alias("pipeline_value"),
        money_sum("weighted_amount").alias("weighted_value")))


def win_rate(fact_opportunity: DataFrame, by: str = "owner_id") -> DataFrame:
    """Won / (won + lost) per ``by``; NULL when nothing is closed."""
    won = F.count_if(F.col("state_code") == WON)
    lost = F.count_if(F.col("state_code") == LOST)
    return fact_opportunity.groupBy(by).agg(won.alias("won_count"), lost.alias("lost_count")).withColumn(
        "win_rate", F.when((F.col("won_count") + F.col("lost_count")) > 0,
                           F.col("won_count") / (F.col("won_count") + F.col("lost_count"))))


def quote_trend(fact_quote: DataFrame) -> DataFrame:
    """Quotes created and their value per month."""
    return fact_quote.groupBy(F.date_trunc("month", "created_ts").alias("quote_month")).agg(
        F.count(F.lit(1)).alias("quote_count"), money_sum("quote_amount").alias("quote_value"))


def _tagged_counts(parts: dict[str, DataFrame]) -> DataFrame:
    """One aggregation over a union of tagged rows: ``{name: frame}`` -> one row of counts.

    Each frame contributes one narrow column, so this is a single partial
    aggregation over a union: no join between the counted inputs.
    """
    tagged = None
    for name, df in parts.items():
        t = df.select(F.lit(name).alias("__part"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return tagged.agg(*[F.count_if(F.col("__part") == name).alias(name) for name in parts])


def quote_conversion(fact_opportunity: DataFrame, fact_quote: DataFrame, fact_contract: DataFrame) -> DataFrame:
    """Share of opportunities with a quote and of quotes with a contract (one row).

    Each fact is read once. Quotes are flagged by a left join with the distinct
    contracted quote ids, then counted per opportunity (partial aggregation, so
    an opportunity with a third of all quotes collapses map-side); one full
    outer join with the opportunity keys, unique on both sides, gives all four
    counts in a single aggregation.
    """
    contracted = fact_contract.select("quote_id").distinct().withColumn("__contracted", F.lit(True))
    per_opportunity = (
        fact_quote.select("quote_id", "opportunity_id")
        .join(contracted, "quote_id", "left")
        .groupBy("opportunity_id")
        .agg(F.count(F.lit(1)).alias("__quotes"), F.count("__contracted").alias("__contracted_quotes"))
    )
    opportunities = fact_opportunity.select("opportunity_id", F.lit(True).alias("__opportunity"))
    counts = opportunities.join(per_opportunity, "opportunity_id", "full_outer").agg(
        F.count("__opportunity").alias("opportunity_count"),
        F.count_if(F.col("__opportunity").isNotNull() & F.col("__quotes").isNotNull())
        .alias("opportunities_with_quote"),
        F.coalesce(F.sum("__quotes"), F.lit(0)).cast("bigint").alias("quote_count"),
        F.coalesce(F.sum("__contracted_quotes"), F.lit(0)).cast("bigint").alias("quotes_with_contract"),
    )
    return counts.select(
        "opportunity_count", "opportunities_with_quote",
        F.when(F.col("opportunity_count") > 0, F.col("opportunities_with_quote") / F.col("opportunity_count"))
        .alias("opportunity_to_quote_rate"),
        "quote_count", "quotes_with_contract",
        F.when(F.col("quote_count") > 0, F.col("quotes_with_contract") / F.col("quote_count"))
        .alias("quote_to_contract_rate"),
    )


def contract_status(as_of: str) -> Column:
    t = _ts(as_of)
    return (F.when(F.col("start_date") > t, F.lit("Future"))
             .when(F.col("end_date") <= t, F.lit("Expired"))
             .otherwise(F.lit("Active")))


def contract_lifecycle(fact_contract: DataFrame, as_of: str) -> DataFrame:
    """Contracts and booked value per start month, split by lifecycle state at ``as_of``."""
    c = fact_contract.withColumn("lifecycle_status", contract_status(as_of))
    return c.groupBy(F.date_trunc("month", "start_date").alias("start_month"), "lifecycle_status").agg(
        F.count(F.lit(1)).alias("contract_count"), money_sum("contract_value").alias("contract_value"))


def executive_kpis(fact_opportunity: DataFrame) -> DataFrame:
    """Pipeline, won, lost and weighted forecast revenue in one pass."""
    st = F.col("state_code")
    v = F.col("estimated_value")
    return fact_opportunity.agg(
        money_sum(F.when(st == OPEN, v)).alias("pipeline_revenue"),
        money_sum(F.when(st == WON, v)).alias("won_revenue"),
        money_sum(F.when(st == LOST, v)).alias("lost_revenue"),
        money_sum(F.when(st == OPEN, F.col("weighted_amount"))).alias("forecast_revenue"),
        F.count_if(st == OPEN).alias("open_count"),
        F.count_if(st == WON).alias("won_count"),
        F.count_if(st == LOST).alias("lost_count"),
    )


def funnel_kpis(fact_opportunity: DataFrame, fact_quote: DataFrame, fact_contract: DataFrame) -> DataFrame:
    """Opportunity, quote and contract counts and the end-to-end conversion rate."""
    counts = _tagged_counts({"opportunity_count": fact_opportunity, "quote_count": fact_quote,
                             "contract_count": fact_contract})
    return counts.withColumn(
        "conversion_rate",
        F.when(F.col("opportunity_count") > 0, F.col("contract_count") / F.col("opportunity_count")))


def activity_kpis(fact_activity: DataFrame) -> DataFrame:
    """Calls and meetings per rep (pivot over the two fixed kinds)."""
    p = fact_activity.groupBy("owner_id").pivot("activity_type", ["phonecall", "appointment"]).count()
    return p.select("owner_id",
                    F.coalesce(F.col("phonecall"), F.lit(0)).alias("calls"),
                    F.coalesce(F.col("appointment"), F.lit(0)).alias("meetings"))


def inactive_opportunities(fact_opportunity: DataFrame, fact_activity: DataFrame, as_of: str,
                           days: int = 7) -> DataFrame:
    """Open opportunities without any activity in the ``days`` before ``as_of``."""
    t = _ts(as_of)
    recent = fact_activity.filter((F.col("created_ts") >= t - F.expr(f"INTERVAL {int(days)} DAYS"))
                                  & (F.col("created_ts") < t)).select("opportunity_id").distinct()
    return fact_opportunity.filter(F.col("state_code") == OPEN).join(recent, "opportunity_id", "left_anti")


def weighted_forecast(fact_opportunity: DataFrame) -> DataFrame:
    """Open weighted pipeline per expected close month."""
    return (fact_opportunity.filter(F.col("state_code") == OPEN).groupBy("expected_close_month").agg(
        F.count(F.lit(1)).alias("opportunity_count"),
        money_sum("estimated_value").alias("pipeline_value"),
        money_sum("weighted_amount").alias("weighted_value")))


def stage_movement(snapshots: DataFrame, key: str, ts_col: str = "snapshot_ts", stage_col: str = "stage_name",
                   amount_col: str = "estimated_value") -> DataFrame:
    """Previous stage and amount of each key's snapshot, and what changed.

    One window per key ordered by snapshot time: a key holds one row per
    snapshot, so its partition is bounded by the number of snapshots.
    """
    w = Window.partitionBy(key).orderBy(ts_col)
    prev_stage = F.lag(stage_col).over(w)
    prev_amount = F.lag(amount_col).over(w)
    return snapshots.select(
        key, ts_col, stage_col, amount_col,
        prev_stage.alias("previous_stage"),
        prev_amount.alias("previous_amount"),
        (F.col(amount_col) - prev_amount).alias("amount_change"),
        F.when(prev_stage.isNull(), F.lit("NEW"))
        .when(prev_stage != F.col(stage_col), F.lit("MOVED"))
        .otherwise(F.lit("SAME")).alias("movement"),
    )
