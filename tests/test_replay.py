"""Property tests: the one-pass replay equals batch-by-batch merges."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import SPEC, log_df, run_ts_of
from revflow.operators.dedup import latest_per_key, silver_order
from revflow.operators.merge import prepare_silver_source
from revflow.operators.replay import latest_active_state, replay_current_state
from revflow.plans.medallion import silver_merge

COLS = ["k", "seq", "v", "is_active", "silver_deleted_ts", "silver_last_event_ts", "silver_last_run_id",
        "silver_updated_ts"]

changes = st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["I", "U", "D"]), st.integers(0, 3)),
                   min_size=1, max_size=14)


def rows_from(ch):
    # unique seq per row = event time order; batch numbers from the draw
    return [(k, i, float(i), op, b) for i, (k, op, b) in enumerate(ch)]


def iterative(spark, rows, hard=False):
    log = log_df(spark, rows)
    state = None
    for b in sorted({r[4] for r in rows}):
        inc = log.filter(F.col("batch") == b).drop("batch", "run_id")
        ts = F.lit(run_ts_of(b)).cast("timestamp")
        src = prepare_silver_source(latest_per_key(inc, ["k"], silver_order(["seq"])), SPEC, f"run-{b}", ts)
        state = silver_merge(state, src, SPEC, f"run-{b}", ts, hard_delete=hard)
        state = spark.createDataFrame(state.collect(), state.schema)
    return sorted(tuple(r) for r in state.select(*COLS).collect())


def one_pass(spark, rows, hard=False):
    log = log_df(spark, rows).withColumn("run_ts", F.make_timestamp(
        F.lit(2024), F.lit(1), F.col("batch") + 1, F.lit(0), F.lit(0), F.lit(0)))
    out = replay_current_state(log, SPEC, "batch", "run_id", "run_ts", ["seq"], hard_delete=hard)
    return sorted(tuple(r) for r in out.select(*COLS).collect())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ch=changes)
def test_replay_equals_iterative_merge(spark, ch):
    rows = rows_from(ch)
    assert one_pass(spark, rows) == iterative(spark, rows)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ch=changes)
def test_replay_equals_iterative_hard_delete(spark, ch):
    rows = rows_from(ch)
    assert one_pass(spark, rows, True) == iterative(spark, rows, True)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ch=changes, cuts=st.lists(st.integers(0, 14), max_size=3))
def test_active_rows_independent_of_time_ordered_split(spark, ch, cuts):
    """Batches that follow event time give the same active keys and values for any split."""
    base = rows_from(ch)
    split = [(k, s, v, op, sum(1 for c in cuts if s >= c)) for k, s, v, op, _ in base]
    one = [(k, s, v, op, 0) for k, s, v, op, _ in base]

    def active(rows):
        return sorted((r[0], r[1]) for r in iterative(spark, rows) if r[3])

    assert active(split) == active(one)
    fast = latest_active_state(log_df(spark, one), SPEC, ["seq"])
    assert sorted((r.k, r.seq) for r in fast.collect()) == active(one)
