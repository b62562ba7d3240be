"""End to end: file drops -> bronze stream -> silver -> gold -> snapshot -> views, with reruns."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from revflow import jobs
from revflow.plans.oracle_sql import AS_OF_SALES
from revflow.sources import crm_feeds as feeds
from revflow.spec import OPPORTUNITY

SF = "/root/testdata/sf0.001"


def test_medallion_end_to_end(spark, scratch):
    ws = jobs.Workspace(spark, f"{scratch}/ws")
    landing = f"{scratch}/landing/opportunity"
    opp = feeds.opportunity_feed(spark, SF)
    n = opp.count()
    # drop 1: all inserts; drop 2: 10 deletes, 5 value updates and one bad row (negative value)
    opp.write.parquet(landing, mode="append")
    upd = opp.orderBy("opportunityid").limit(15).withColumn("modifiedon", F.col("modifiedon") + F.expr("INTERVAL 1 DAY"))
    dels = upd.limit(10).withColumn("change_operation", F.lit("D"))
    ups = upd.orderBy(F.col("opportunityid").desc()).limit(5).withColumns(
        {"change_operation": F.lit("U"), "estimatedvalue": F.lit(1.0)})
    bad = upd.limit(1).withColumns({"change_operation": F.lit("U"), "estimatedvalue": F.lit(-5.0),
                                    "opportunityid": F.lit(-1).cast("long")})
    schema = opp.schema
    t1, t2 = datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2)

    assert jobs.run_bronze(ws, OPPORTUNITY, landing, schema, "b1", now=t1) == n
    assert jobs.run_silver(ws, OPPORTUNITY, "s1", now=t1) == "success"
    assert jobs.run_gold(ws, OPPORTUNITY, "g1", now=t1) == "success"
    assert ws.gold("fact_opportunity").read().count() == n
    assert jobs.run_silver(ws, OPPORTUNITY, "s1b", now=t1) == "skipped"  # nothing new

    dels.unionByName(ups).unionByName(bad).write.parquet(landing, mode="append")
    assert jobs.run_bronze(ws, OPPORTUNITY, landing, schema, "b2", now=t2) == 16
    assert jobs.run_silver(ws, OPPORTUNITY, "s2", now=t2) == "partial_success"
    assert jobs.run_gold(ws, OPPORTUNITY, "g2", now=t2) == "success"

    silver = ws.silver("opportunity").read()
    assert silver.count() == n and silver.filter(~F.col("is_active")).count() == 10
    gold = ws.gold("fact_opportunity").read()
    assert gold.count() == n - 10 and gold.filter(~F.col("is_active")).count() == 0
    assert gold.filter(F.col("estimated_value") == 1.0).count() == 5
    assert ws.bad_records().count() == 1

    # idempotent snapshot and serving views
    assert jobs.run_snapshot(ws, AS_OF_SALES, "snap1", now=t2) == "success"
    assert jobs.run_snapshot(ws, AS_OF_SALES, "snap2", now=t2) == "success"
    assert ws.snapshots().count() == n - 10
    views = jobs.serving_views(ws, AS_OF_SALES)
    assert views["vw_rep_scorecard"].agg(F.sum("open_opportunity_count")).first()[0] == n - 10
    assert spark.table("vw_opportunity_pipeline").count() == n - 10

    runs = {r.run_id: r.status for r in ws.runs().collect()}
    assert runs["s1b"] == "skipped" and runs["s2"] == "partial_success" and runs["g2"] == "success"
    cur = ws.watermarks().filter("is_current").groupBy("entity_name", "layer_name").count()
    assert cur.filter("count != 1").count() == 0

    before = sorted(ws.gold("fact_opportunity").read().collect())
    assert set(jobs.run_maintenance(ws, entities=("opportunity",)).values()) == {"folded"}
    assert sorted(ws.gold("fact_opportunity").read().collect()) == before


def test_failed_run_is_logged(spark, scratch):
    ws = jobs.Workspace(spark, f"{scratch}/ws2")
    try:
        jobs.run_silver(ws, OPPORTUNITY, "bad-run", now=datetime(2024, 1, 1))
    except Exception:  # noqa: BLE001  no bronze table yet
        pass
    r = ws.runs().filter("run_id = 'bad-run'").first()
    assert r.status == "failed" and r.error_message


def test_activity_job(spark, scratch):
    from revflow.spec import APPOINTMENT, PHONECALL

    ws = jobs.Workspace(spark, f"{scratch}/ws3")
    now = datetime(2024, 1, 31)
    total = 0
    for spec in (PHONECALL, APPOINTMENT):
        feed = feeds.activity_feed(spark, SF, spec.name)
        total += feed.count()
        landing = f"{scratch}/landing/{spec.name}"
        feed.write.parquet(landing)
        jobs.run_bronze(ws, spec, landing, feed.schema, f"b-{spec.name}", now=now)
        assert jobs.run_silver(ws, spec, f"s-{spec.name}", now=now) == "success"
    assert jobs.run_activity(ws, "act-1", now=now) == "success"
    fact = ws.gold("fact_activity").read()
    assert fact.count() == total
    assert fact.groupBy("activity_type").count().count() == 2
    assert jobs.run_activity(ws, "act-2", now=now) == "success"  # full re-merge is idempotent
    assert ws.gold("fact_activity").read().count() == total
    assert spark.table("vw_sales_activity").count() == total


def test_backfill_and_added_column(spark, scratch):
    """A backfill leaves the watermark and the quarantine alone; an added column loses nothing."""
    from pyspark.sql import functions as F

    from revflow.sources import crm_feeds as feeds
    from revflow.spec import OPPORTUNITY

    ws = jobs.Workspace(spark, f"{scratch}/ws3")
    feed = feeds.opportunity_feed(spark, "/root/testdata/sf0.001")
    landing = f"{scratch}/landing3"
    feed.write.parquet(landing)
    jobs.run_bronze(ws, OPPORTUNITY, landing, feed.schema, "b1")
    jobs.run_silver(ws, OPPORTUNITY, "s1")
    jobs.run_gold(ws, OPPORTUNITY, "g1")
    mark, bad = ws.watermark("opportunity", "silver"), ws.bad_records().count()
    rows = ws.silver("opportunity").read().count()
    key = OPPORTUNITY.primary_key

    other = jobs.Workspace(spark, f"{scratch}/ws3")
    jobs.run_silver(other, OPPORTUNITY, "s2", backfill=("2000-01-01 00:00:00", "2100-01-01 00:00:00"))
    assert other.watermark("opportunity", "silver") == mark and other.bad_records().count() == bad
    state = other.silver("opportunity").read()
    assert state.count() == rows == state.select(key).distinct().count()
    assert jobs.run_silver(other, OPPORTUNITY, "s3") == "skipped"

    wider = feed.limit(50).withColumn("region_code", F.lit("EU"))
    wider.write.mode("append").parquet(landing)
    jobs.run_bronze(ws, OPPORTUNITY, landing, wider.schema, "b2")
    assert jobs.run_silver(ws, OPPORTUNITY, "s4") != "skipped"
    state = ws.silver("opportunity").read()
    assert "region_code" in state.columns
    assert state.count() == rows
    assert 0 < state.filter("region_code = 'EU'").count() <= 50


def test_backfill_does_not_overwrite_newer_rows(spark, scratch):
    """T4 in a backfill: an old change that is read again leaves the newer state alone, before and after a fold."""
    ws = jobs.Workspace(spark, f"{scratch}/ws5")
    feed = feeds.opportunity_feed(spark, SF).limit(20)
    landing = f"{scratch}/landing5"
    feed.write.parquet(landing)
    jobs.run_bronze(ws, OPPORTUNITY, landing, feed.schema, "b1", now=datetime(2024, 1, 1))
    jobs.run_silver(ws, OPPORTUNITY, "s1", now=datetime(2024, 1, 1))
    newer = feed.withColumns({"modifiedon": F.col("modifiedon") + F.expr("INTERVAL 1 DAY"), "change_operation": F.lit("U"), "estimatedvalue": F.lit(2.0)})
    newer.write.mode("append").parquet(landing)
    jobs.run_bronze(ws, OPPORTUNITY, landing, feed.schema, "b2", now=datetime(2024, 1, 2))
    jobs.run_silver(ws, OPPORTUNITY, "s2", now=datetime(2024, 1, 2))
    first = spark.read.parquet(ws.path("bronze", "opportunity")).filter("bronze_pipeline_run_id = 'b1'").agg(
        F.min("bronze_ingest_ts"), F.max("bronze_ingest_ts")).first()
    window = (first[0], first[1] + timedelta(microseconds=1))
    for run in ("s3", "s4"):
        jobs.run_silver(ws, OPPORTUNITY, run, now=datetime(2024, 1, 3), backfill=window)
        state = ws.silver("opportunity").read()
        assert state.count() == 20 == state.filter("estimatedvalue = 2.0 and silver_last_run_id = 's2'").count()
        ws.silver("opportunity").fold("opportunityid")


def test_gold_increment_reads_only_later_changes(spark, scratch):
    """A delete in a later run reaches gold, though the change that wrote its attributes is not in the increment; counts are of that run."""
    ws = jobs.Workspace(spark, f"{scratch}/ws6")
    feed = feeds.opportunity_feed(spark, SF).limit(30)
    landing = f"{scratch}/landing6"
    feed.write.parquet(landing)
    jobs.run_bronze(ws, OPPORTUNITY, landing, feed.schema, "b1")
    assert jobs.run_silver(ws, OPPORTUNITY, "s1") == "success" and jobs.run_gold(ws, OPPORTUNITY, "g1") == "success"
    ws.silver("opportunity").fold("opportunityid")  # the older rows are in the base now
    ids = [r[0] for r in feed.select("opportunityid").orderBy("opportunityid").limit(3).collect()]
    later = feed.filter(F.col("opportunityid").isin(ids)).withColumns({"change_operation": F.lit("D"), "modifiedon": F.col("modifiedon") + F.expr("INTERVAL 1 DAY")})
    unknown = later.limit(1).withColumn("opportunityid", F.lit(-7).cast("long"))  # a delete of a key that never was
    later.unionByName(unknown).write.mode("append").parquet(landing)
    jobs.run_bronze(ws, OPPORTUNITY, landing, feed.schema, "b2")
    assert jobs.run_silver(ws, OPPORTUNITY, "s2") == "success" and jobs.run_gold(ws, OPPORTUNITY, "g2") == "success"
    runs = {r.run_id: r for r in ws.runs().collect()}
    assert (runs["s2"].source_row_count, runs["g2"].source_row_count, runs["g2"].target_row_count) == (4, 3, 0)
    gold = ws.gold("fact_opportunity").read()
    assert gold.count() == 27 and gold.filter(F.col("opportunity_id").isin(ids)).count() == 0
    assert jobs.run_gold(ws, OPPORTUNITY, "g3") == "skipped"


def test_runs_in_a_zone_west_of_utc(spark, scratch):
    """Watermarks are instants: a workspace written in one zone is read on in another, and every row is counted."""
    ws = jobs.Workspace(spark, f"{scratch}/ws7")
    feed = feeds.opportunity_feed(spark, SF).limit(40)
    landing = f"{scratch}/landing7"
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for i, name in enumerate(("America/Los_Angeles", "Pacific/Kiritimati", "America/Los_Angeles")):
            spark.conf.set("spark.sql.session.timeZone", name)
            part = feed.filter(F.col("opportunityid") % 3 == i)
            n = part.count()
            part.write.mode("append").parquet(landing)
            assert jobs.run_bronze(ws, OPPORTUNITY, landing, feed.schema, f"b{i}") == n
            assert jobs.run_silver(ws, OPPORTUNITY, f"s{i}") == "success" and jobs.run_gold(ws, OPPORTUNITY, f"g{i}") == "success"
            assert jobs.run_silver(ws, OPPORTUNITY, f"again{i}") == "skipped"
            runs = {r.run_id: r.source_row_count for r in ws.runs().collect()}
            assert runs[f"b{i}"] == runs[f"s{i}"] == runs[f"g{i}"] == n
        assert ws.gold("fact_opportunity").read().count() == feed.count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_quarantine_and_dedup_settings(spark, scratch):
    ws = jobs.Workspace(spark, f"{scratch}/ws8")
    feed = feeds.opportunity_feed(spark, SF).limit(10)
    landing = f"{scratch}/landing8"
    bad = feed.limit(2).withColumn("estimatedvalue", F.lit(-1.0))
    feed.unionByName(bad).write.parquet(landing)
    jobs.run_bronze(ws, OPPORTUNITY, landing, feed.schema, "b")
    assert jobs.run_silver(ws, OPPORTUNITY.with_(quarantine_enabled=False, dedup_enabled=False), "s") == "partial_success"
    assert ws.bad_records().count() == 0 and ws.silver("opportunity").read().count() == 10
    feed.limit(1).write.mode("append").parquet(landing)
    feed.limit(1).write.mode("append").parquet(landing)
    jobs.run_bronze(ws, OPPORTUNITY, landing, feed.schema, "b2")
    try:
        jobs.run_silver(ws, OPPORTUNITY.with_(dedup_enabled=False), "s2")
        raise AssertionError("a key twice in one increment must fail without dedup")
    except ValueError:
        pass
    assert {r.run_id: r.status for r in ws.runs().collect()}["s2"] == "failed"


def test_snapshot_dates_are_overwritten_alone(spark, scratch):
    """M4: a rerun replaces its own date's partition only, and is idempotent; other times of the date stay."""
    ws = jobs.Workspace(spark, f"{scratch}/ws9")
    feed = feeds.opportunity_feed(spark, SF).limit(12)
    landing = f"{scratch}/landing9"
    feed.write.parquet(landing)
    jobs.run_bronze(ws, OPPORTUNITY, landing, feed.schema, "b")
    jobs.run_silver(ws, OPPORTUNITY, "s")
    jobs.run_gold(ws, OPPORTUNITY, "g")
    for i, ts in enumerate(("2001-08-01 06:00:00", "2001-08-02 06:00:00", "2001-08-02 18:00:00")):
        assert jobs.run_snapshot(ws, ts, f"n{i}", now=datetime(2024, 1, 1)) == "success"
    other = lambda: {f for f in ws.snapshots().inputFiles() if "snapshot_date=2001-08-01" in f}
    files = other()
    rows = sorted(ws.snapshots().drop("snapshot_run_id").collect())
    assert jobs.run_snapshot(ws, "2001-08-02 06:00:00", "again", now=datetime(2024, 1, 1)) == "success"
    assert sorted(ws.snapshots().drop("snapshot_run_id").collect()) == rows and len(rows) == 36
    assert other() == files


def test_activity_increments_equal_a_full_refresh(spark, scratch):
    """After each drop the appended fact equals a full refresh; only changed activities are read."""
    from revflow.operators.facts import current_activity
    from revflow.spec import APPOINTMENT, PHONECALL

    ws = jobs.Workspace(spark, f"{scratch}/ws10")
    feeds_of = {s.name: feeds.activity_feed(spark, SF, s.name).limit(60).persist() for s in (PHONECALL, APPOINTMENT)}
    later = lambda df, days, op: df.withColumns({"modifiedon": F.col("modifiedon") + F.expr(f"INTERVAL {days} DAY"), "change_operation": F.lit(op)})
    both = feeds_of["phonecall"].limit(4)  # ids that the other kind has too
    drops = [
        {"phonecall": feeds_of["phonecall"], "appointment": feeds_of["appointment"]},
        {"phonecall": later(feeds_of["phonecall"].limit(5), 1, "D")},
        {"appointment": later(both, 3, "I").unionByName(later(feeds_of["appointment"].limit(2), 2, "U"))},
        {"appointment": later(both.limit(2), 5, "D"), "phonecall": later(both, 4, "U")},
    ]
    read = []
    for i, drop in enumerate(drops):
        for spec in (PHONECALL, APPOINTMENT):
            if spec.name in drop:
                drop[spec.name].write.mode("append").parquet(f"{scratch}/landing10/{spec.name}")
                jobs.run_bronze(ws, spec, f"{scratch}/landing10/{spec.name}", feeds_of[spec.name].schema, f"b{i}-{spec.name}")
                jobs.run_silver(ws, spec, f"s{i}-{spec.name}")
        assert jobs.run_activity(ws, f"a{i}") == "success"
        read.append({r.run_id: r.source_row_count for r in ws.runs().collect()}[f"a{i}"])
        full = current_activity(ws.silver("phonecall").read(), ws.silver("appointment").read(), duplicates="latest").drop("gold_updated_ts")
        cols = full.columns
        got = ws.gold("fact_activity").read().select(*cols)
        assert sorted(map(str, got.collect())) == sorted(map(str, full.collect()))
        if i == 1:
            ws.gold("fact_activity").fold("activity_id")
    assert read == [120, 5, 6, 6]
    assert jobs.run_activity(ws, "a9") == "success"  # nothing to read
    assert {r.run_id: r.source_row_count for r in ws.runs().collect()}["a9"] == 0
