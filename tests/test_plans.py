"""Physical-plan properties of the registered queries (checked on sf0.001)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# These run streams, job chains or merge loops first and return a read of what they wrote.
WRITERS = {"bronze_stream", "cdc_stream_state", "medallion_jobs_fact", "silver_incremental_merge",
           "silver_late_data", "feed_formats", "compacted_fact", "opportunity_snapshot", "snapshot_age_buckets", "schema_evolution",
           "landed_drift", "activity_incremental", "snapshot_movement", "pipeline_trend", "z_ordered_fact"}


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(fn(spark, SF)) for name, fn in E.queries().items() if name not in WRITERS}


def test_no_cross_products_or_python_in_any_plan(plans):
    bad = {n: [f for f in FORBIDDEN if f in p] for n, p in plans.items()}
    assert {n: f for n, f in bad.items() if f} == {}


def test_dedup_limits_before_the_shuffle(plans):
    p = plans["latest_per_key"]
    assert "WindowGroupLimit" in p and "Partial" in p


def test_flagship_reads_only_needed_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df = E.queries()["rep_scorecard"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in text.splitlines() if "FileScan parquet" in line][0]
    read_schema = scan.split("ReadSchema:")[1]
    # key, owner, value, event time and priority are read; the order status is not needed
    for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"):
        assert c in read_schema
    assert "o_orderstatus" not in read_schema


def test_bucketed_merge_broadcasts_only_the_touched_set(spark):
    from pyspark.sql import functions as F

    from revflow.operators.merge import Clause, bucket_of, keyed_merge

    tgt = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("x")) \
        .withColumn("_bucket", bucket_of(["k"], 16))
    src = spark.range(5).select(F.col("id").alias("k"), (F.col("id") + 1).alias("x")) \
        .withColumn("_bucket", bucket_of(["k"], 16))
    out = keyed_merge(tgt, src, ["k"], [Clause({"x": F.col("src.x")})], [], bucket_col="_bucket", touched_only=True)
    p = plan_of(out)
    assert "BroadcastExchange" in p and "LeftSemi" in p


def test_appended_changes_are_pruned_and_proportional(spark, scratch):
    """A run adds only its own files; what changed after a mark is found without reading older runs' files."""
    from revflow.operators.fold import ORDER, fold_increment
    from revflow.plans import registry as R
    from revflow.plans.medallion import append_batches
    from revflow.sources.deltas import state_table

    table = state_table(spark, f"{scratch}/t", R.EVENT_SPEC)
    valid = R.event_valid(spark, SF)
    days = [r[0] for r in valid.select("batch_date").distinct().orderBy("batch_date").limit(4).collect()]

    def add(day):
        append_batches(table, valid.filter(F.col("batch_date") == F.lit(day)), R.EVENT_SPEC, "batch_date", R._run_id_of, R._run_ts_of, R.EVENT_TIE_BREAKERS)

    for d in days[:3]:
        add(d)
    before = set(table.appended().inputFiles())
    add(days[3])
    after = set(table.appended().inputFiles())
    assert before < after
    last = table.appended().agg(F.max(ORDER)).first()[0]
    table.fold("user_id")
    mark = F.timestamp_micros(F.lit(last - 1))
    scans = [x.split("]")[0] for x in plan_of(fold_increment(table.changes(), R.EVENT_SPEC, mark)).split("PartitionFilters: [")[1:]]
    assert any(f"{last - 1})" in x and ORDER in x for x in scans)
    assert table.read().count() == R.event_state(spark, SF, where=F.col("batch_date") <= F.lit(days[3])).count()


def test_fold_shuffles_once(spark, scratch):
    """The current state is one exchange over the live changes, partially folded before it."""
    from revflow.plans import registry as R
    from revflow.plans.medallion import append_batches
    from revflow.sources.deltas import state_table

    table = state_table(spark, f"{scratch}/u", R.EVENT_SPEC)
    append_batches(table, R.event_valid(spark, SF), R.EVENT_SPEC, "batch_date", R._run_id_of, R._run_ts_of, R.EVENT_TIE_BREAKERS)
    assert plan_of(table.read()).count("Exchange hashpartitioning") == 1
    assert table.fold("user_id") is not None and table.fold("user_id") is None
    assert plan_of(table.read()).count("Exchange hashpartitioning") == 1


def test_compaction_of_more_rows_than_32_target_files(spark, scratch):
    n = 1_650_000  # 33 files of 50,000 rows
    spark.range(n).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 1000).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        (F.col("id") % 97 + 1).cast("double").alias("o_totalprice"), F.lit("1997-05-01 10:00:00").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{scratch}/orders.parquet")
    out = E.queries()["compacted_fact"](spark, scratch)
    found = out.agg(F.count("*"), F.count_distinct("opportunity_id"), F.sum("opportunity_id"), F.sum("estimated_value")).first()
    assert tuple(found) == (n, n, n * (n - 1) // 2, sum(i % 97 + 1 for i in range(n)))
    assert len(out.inputFiles()) == 33
