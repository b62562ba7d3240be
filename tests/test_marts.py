from datetime import date, datetime

from pyspark.sql import functions as F

from revflow.functions.columns import age_bucket, delete_flag, weighted_amount, with_snapshot_stamp
from revflow.plans import dims, marts


def test_age_buckets_null_and_negative(spark):
    df = spark.createDataFrame([(None,), (-3,), (7,), (8,), (30,), (31,), (60,), (90,), (91,)], "d int")
    got = [r[0] for r in df.select(age_bucket(F.col("d"))).collect()]
    assert got == ["90+ days", "0-7 days", "0-7 days", "8-30 days", "8-30 days", "31-60 days", "31-60 days",
                   "61-90 days", "90+ days"]


def test_snapshot_stamp_ages(spark):
    df = spark.createDataFrame([(date(2001, 7, 1), date(2001, 7, 20))], "created_date date, expected_close_date date")
    r = with_snapshot_stamp(df, "2001-08-01 13:45:00", "s1", created_ts=F.lit(None).cast("timestamp")).first()
    assert r.days_open == 31 and r.days_to_expected_close == -12 and r.pipeline_age_bucket == "31-60 days"
    assert r.snapshot_date == date(2001, 8, 1) and r.snapshot_hour == datetime(2001, 8, 1, 13, 0)


def test_weighted_amount_and_delete_flag(spark):
    df = spark.createDataFrame([(100.0, 50.0, True), (None, 50.0, False), (10.0, None, None)],
                               "estimated_value double, probability double, is_active boolean")
    rows = df.select(weighted_amount().alias("w"), delete_flag().alias("f")).collect()
    assert [(r.w, r.f) for r in rows] == [(50.0, False), (None, True), (None, False)]


def test_money_sum_is_partitioning_independent(spark):
    vals = [0.1, 0.2, 0.3, 1e9 + 0.07, -0.05] * 200
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = df.repartition(1).agg(marts.money_sum("x")).first()[0]
    b = df.repartition(17).agg(marts.money_sum("x")).first()[0]
    assert a == b == round(sum(round(v, 6) for v in vals), 2)


def test_win_rate_and_stale(spark):
    f = spark.createDataFrame([(1, "Won", datetime(2001, 6, 1)), (1, "Lost", datetime(2001, 7, 15)),
                               (2, "Open", datetime(2001, 7, 2))],
                              "owner_id long, state_code string, modified_ts timestamp")
    w = {r.owner_id: r.win_rate for r in marts.win_rate(f).collect()}
    assert w == {1: 0.5, 2: None}
    stale = marts.stale_deals(f, "2001-08-01 00:00:00").collect()
    assert [r.state_code for r in stale] == ["Won"]  # 2001-07-02 is exactly 30 days before: not stale


def test_stage_movement(spark):
    s = spark.createDataFrame([(1, 1, "a", 1.0), (1, 2, "a", 3.0), (1, 3, "b", 3.0), (2, 1, "x", 5.0)],
                              "k long, t long, stage_name string, estimated_value double")
    got = {(r.k, r.t): (r.movement, r.amount_change) for r in marts.stage_movement(s, "k", "t").collect()}
    assert got == {(1, 1): ("NEW", None), (1, 2): ("SAME", 2.0), (1, 3): ("MOVED", 0.0), (2, 1): ("NEW", None)}


def test_standard_stage_and_dims(spark):
    opp = spark.createDataFrame([(1, "Won", date(2001, 1, 1)), (2, "Open", date(2001, 1, 3)),
                                 (3, "Open", date(2001, 1, 2)), (4, "Open", date(2001, 1, 2)), (5, "Closed", None)],
                                "opportunity_id long, state_code string, created_date date")
    quotes = spark.createDataFrame([(2,), (2,)], "opportunity_id long")
    acts = spark.createDataFrame([(3, "phonecall"), (None, "appointment")], "opportunity_id long, activity_type string")
    st = {r.opportunity_id: r.standard_stage for r in dims.standard_stage(opp, quotes, acts).collect()}
    assert st == {1: "Won", 2: "Quoted", 3: "In Progress", 4: "Open", 5: "Closed"}
    d = dims.dim_date(opp, "created_date").collect()
    assert [r.date_key for r in d] == [20010101, 20010102, 20010103] and d[0].weekday == 1  # a Monday
    assert dims.dim_stage(dims.standard_stage(opp, quotes, acts)).count() == 5


def test_quote_conversion_edges(spark):
    """IN semantics: a quote whose opportunity is unknown or NULL counts as a quote but
    marks no opportunity; several quotes of one opportunity mark it once; a contract
    for an unknown quote counts nothing."""
    opp = spark.createDataFrame([(1,), (2,), (3,)], "opportunity_id long")
    quotes = spark.createDataFrame([(10, 1), (11, 1), (12, 2), (13, 9), (14, None)],
                                   "quote_id long, opportunity_id long")
    contracts = spark.createDataFrame([(10,), (10,), (13,), (99,), (None,)], "quote_id long")
    r = marts.quote_conversion(opp, quotes, contracts).first()
    assert (r.opportunity_count, r.opportunities_with_quote, r.quote_count, r.quotes_with_contract) == (3, 2, 5, 2)
    assert r.opportunity_to_quote_rate == 2 / 3 and r.quote_to_contract_rate == 2 / 5
    empty = marts.quote_conversion(opp.limit(0), quotes.limit(0), contracts.limit(0)).first()
    assert (empty.opportunity_count, empty.quote_count, empty.quotes_with_contract) == (0, 0, 0)
    assert empty.opportunity_to_quote_rate is None and empty.quote_to_contract_rate is None
