import pytest
from pyspark.sql import functions as F

from revflow.plans.registry import EVENT_SCHEMA, EVENT_SPEC
from revflow.sources import crm_feeds as feeds
from revflow.sources.files import infer_feed_schema
from revflow.sources.deltas import state_table
from revflow.streaming.cdc import CurrentStateWriter
from revflow.streaming.ingest import bronze_stream, read_feed_stream, run_bronze_available_now, trigger_kwargs

SF = "/root/testdata/sf0.001"


def test_trigger_modes():
    assert trigger_kwargs("available_now") == {"availableNow": True}
    assert trigger_kwargs("micro_batch") == {"processingTime": "5 minutes"}
    assert trigger_kwargs("micro_batch", "1 minute") == {"processingTime": "1 minute"}
    with pytest.raises(ValueError):
        trigger_kwargs("continuous")
    with pytest.raises(ValueError):
        trigger_kwargs("hourly")


def test_stream_two_drops_exactly_once(spark, scratch):
    landing, table, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    ev = feeds.table(spark, SF, "events")
    ev.filter("event_id % 2 = 0").write.parquet(landing, mode="append")
    schema = infer_feed_schema(spark, landing)
    assert [f.name for f in schema.fields] == [f.name for f in EVENT_SCHEMA.fields]

    def once():
        raw = read_feed_stream(spark, landing, EVENT_SCHEMA)
        run_bronze_available_now(bronze_stream(raw, EVENT_SPEC, "r"), table, ckpt)
        return spark.read.parquet(table).count()

    n_even = once()
    assert n_even == ev.filter("event_id % 2 = 0").count()
    assert once() == n_even  # rerun without new files adds nothing
    ev.filter("event_id % 2 = 1").write.parquet(landing, mode="append")
    assert once() == ev.count()
    files = spark.read.parquet(table).select(F.element_at(F.split("bronze_source_file_path", "/"), -1)).distinct()
    assert files.count() >= 2


def test_foreach_batch_replay_changes_nothing(spark, scratch):
    state = state_table(spark, f"{scratch}/state", EVENT_SPEC)
    w = CurrentStateWriter(state, EVENT_SPEC, lambda b: f"s-{b}", f"{scratch}/bad", F.lit("2024-02-01").cast("timestamp"),
                           ["event_id"])
    batch = feeds.event_changes(spark, SF)
    from revflow.plans.medallion import bronze_rows

    b = bronze_rows(batch, EVENT_SPEC, "r", F.col("batch_ingest_ts"))
    w(b, 0)
    rows = sorted(map(str, state.read().collect()))
    runs = state.appended().select("_order", "_run").distinct().collect()
    w(b, 0)  # the same micro-batch delivered again
    assert state.appended().select("_order", "_run").distinct().collect() == runs and len(runs) == 1
    assert sorted(map(str, state.read().collect())) == rows
    before = state.read().count()
    w(b.filter("event_id < 0"), 1)  # an empty batch changes nothing
    assert state.read().count() == before


def test_second_checkpoint_and_bad_rows_of_every_batch(spark, scratch):
    """A stream on a new checkpoint starts at batch 0 again: its batches are merged, not taken for replays, and the bad
    rows of all batches stay readable."""
    from revflow.streaming.cdc import read_quarantine, start_current_state_stream

    landing = f"{scratch}/landing"
    state = state_table(spark, f"{scratch}/state", EVENT_SPEC)
    w = CurrentStateWriter(state, EVENT_SPEC, lambda b: f"s-{b}", f"{scratch}/bad", F.lit("2024-02-01").cast("timestamp"),
                           ["event_id"])
    events = feeds.table(spark, SF, "events")
    bad = lambda n: events.limit(n).withColumn("user_id", F.lit(None).cast(events.schema["user_id"].dataType))
    parts = [events.filter("event_id % 2 = 0").unionByName(bad(3)), events.filter("event_id % 2 = 1").unionByName(bad(2))]
    for n, part in enumerate(parts):
        w.run_id_of = lambda b, n=n: f"s{n}-{b}"
        part.write.parquet(f"{landing}{n}")
        raw = read_feed_stream(spark, f"{landing}{n}", EVENT_SCHEMA)
        bronze = bronze_stream(feeds.event_changes_of(raw), EVENT_SPEC, "b", F.lit("2024-02-01").cast("timestamp"))
        start_current_state_stream(bronze, w, f"{scratch}/ckpt{n}").awaitTermination()
    assert {r[0].split("-")[0] for r in state.read().select("silver_last_run_id").collect()} >= {"s1"}
    assert read_quarantine(spark, f"{scratch}/bad").count() == 5


def test_micro_batch_bronze_run(spark, scratch):
    from revflow import jobs
    from revflow.spec import OPPORTUNITY

    ws = jobs.Workspace(spark, f"{scratch}/ws")
    feed = feeds.opportunity_feed(spark, SF)
    landing = f"{scratch}/landing"
    feed.write.parquet(landing)
    q = jobs.run_bronze(ws, OPPORTUNITY, landing, feed.schema, "mb-1", trigger_mode="micro_batch",
                        interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(ws.path("bronze", "opportunity")).count() == feed.count()
