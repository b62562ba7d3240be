from datetime import datetime, timedelta

from pyspark.sql import functions as F

from revflow.operators import control
from revflow.plans import ops_views

T0 = datetime(2024, 1, 31, 0, 0)


def test_run_fold_start_success_failure(spark):
    ev = control.run_start_event(spark, "r1", None, "p", "opportunity", "silver", "manual", 1, T0)
    ev = ev.unionByName(control.run_end_event(spark, "r1", T0 + timedelta(minutes=5), source_row_count=10,
                                              target_row_count=8, rows_quarantined=2))
    ev = ev.unionByName(control.run_start_event(spark, "r2", "r1", "p", "quote", "gold", "manual", 1, T0))
    ev = ev.unionByName(control.run_end_event(spark, "r2", T0 + timedelta(minutes=1), status="failed",
                                              error_message="x" * 5000))
    runs = {r.run_id: r for r in control.fold_runs(ev).collect()}
    assert runs["r1"].status == "partial_success" and runs["r1"].source_row_count == 10
    assert runs["r1"].pipeline_name == "p" and runs["r1"].run_end_ts == T0 + timedelta(minutes=5)
    assert runs["r2"].status == "failed" and len(runs["r2"].error_message) == 5000  # whole
    assert runs["r2"].parent_run_id == "r1"


def test_exactly_one_current_watermark(spark):
    ev = None
    for i in range(5):
        for layer in ("silver", "gold"):
            e = control.watermark_event(spark, "opportunity", layer, "t", f"v{i}", f"r{i}", T0 + timedelta(hours=i))
            ev = e if ev is None else ev.unionByName(e)
    marked = control.mark_current(ev)
    cur = marked.filter("is_current").collect()
    assert sorted((r.layer_name, r.watermark_value) for r in cur) == [("gold", "v4"), ("silver", "v4")]
    assert control.get_current_watermark(marked, "opportunity", "silver") == "v4"
    assert control.get_current_watermark(marked, "quote", "silver") is None
    assert control.current_watermarks(ev).count() == 2


def test_one_current_watermark_where_times_tie(spark):
    ev = control.watermark_event(spark, "quote", "gold", "t", "first", "r1", T0)
    ev = ev.unionByName(control.watermark_event(spark, "quote", "gold", "t", "second", "r2", T0))
    assert [r.watermark_value for r in control.mark_current(ev).filter("is_current").collect()] == ["second"]
    assert [r.watermark_value for r in control.current_watermarks(ev).collect()] == ["second"]


def test_health_and_staleness(spark):
    rows = [("r1", "opportunity", "silver", "running", T0 - timedelta(minutes=10)),
            ("r2", "quote", "silver", "skipped", T0 - timedelta(minutes=40)),
            ("r3", "contract", "gold", "partial_success", T0),
            ("r4", "phonecall", "gold", "failed", T0)]
    reg = spark.createDataFrame(rows, "run_id string, entity_name string, layer_name string, status string, "
                                      "updated_ts timestamp") \
        .withColumns({"source_row_count": F.lit(1).cast("long"), "rows_quarantined": F.lit(0).cast("long")})
    h = {r.entity_name: r.health_status for r in ops_views.health_summary(reg, "2024-01-31 00:00:00").collect()}
    assert h == {"opportunity": "GREEN", "quote": "AMBER", "contract": "AMBER", "phonecall": "RED"}
    wm = spark.createDataFrame([("e", "gold_snapshot", T0 - timedelta(hours=27), True),
                                ("e", "silver", T0 - timedelta(minutes=31), True),
                                ("e", "bronze", T0 - timedelta(minutes=5), True),
                                ("e", "gold", T0 - timedelta(days=5), False)],
                               "entity_name string, layer_name string, updated_ts timestamp, is_current boolean")
    s = {r.layer_name: r.freshness_status for r in ops_views.stale_watermarks(wm, "2024-01-31 00:00:00").collect()}
    assert s == {"gold_snapshot": "STALE_SNAPSHOT", "silver": "STALE_SILVER", "bronze": "OK"}


def test_schema_drift(spark):
    from pyspark.sql import types as T

    exp = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    act = T.StructType([T.StructField("a", T.StringType()), T.StructField("c", T.DateType())])
    d = {r.column_name: r.change for r in ops_views.schema_drift(exp, act, spark).collect()}
    assert d == {"a": "TYPE_CHANGED", "b": "MISSING_COLUMN", "c": "NEW_COLUMN"}
