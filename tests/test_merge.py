import pytest
from pyspark.sql import functions as F

from helpers import SPEC, log_df, run_ts_of
from revflow.operators.dedup import ensure_unique, latest_per_key, silver_order
from revflow.operators.merge import (
    DELETE, Clause, bucket_of, keyed_merge, merge_current_state, merge_fact, merge_snapshot, prepare_silver_source)
from revflow.plans.medallion import silver_merge


def apply_batches(spark, rows, **kw):
    log = log_df(spark, rows)
    state = None
    for b in sorted({r[4] for r in rows}):
        inc = log.filter(F.col("batch") == b).drop("batch")
        ts = F.lit(run_ts_of(b)).cast("timestamp")
        src = prepare_silver_source(latest_per_key(inc, ["k"], silver_order(["seq"])), SPEC, f"run-{b}", ts)
        state = silver_merge(state, src, SPEC, f"run-{b}", ts, **kw)
        state = spark.createDataFrame(state.collect(), state.schema)
    return {r.k: r for r in state.collect()} if state is not None else {}


def test_delete_then_update_revives(spark):
    s = apply_batches(spark, [(1, 1, 10.0, "I", 1), (1, 2, 0.0, "D", 2), (1, 3, 30.0, "U", 3)])
    assert s[1].is_active and s[1].v == 30.0 and s[1].silver_deleted_ts is None


def test_delete_of_unknown_key_inserts_nothing(spark):
    assert apply_batches(spark, [(5, 1, 1.0, "D", 1)]) == {}


def test_matched_delete_keeps_attributes(spark):
    s = apply_batches(spark, [(1, 1, 10.0, "I", 1), (1, 2, 99.0, "D", 2)])
    r = s[1]
    assert not r.is_active and r.v == 10.0 and r.silver_last_run_id == "run-2"
    assert str(r.silver_deleted_ts) == "2024-01-01 00:02:00"


def test_insert_and_delete_in_one_batch_leaves_no_row(spark):
    assert apply_batches(spark, [(1, 1, 10.0, "I", 1), (1, 2, 0.0, "D", 1)]) == {}


def test_hard_delete_removes_row(spark):
    s = apply_batches(spark, [(1, 1, 10.0, "I", 1), (2, 1, 5.0, "I", 1), (1, 2, 0.0, "D", 2)], hard_delete=True)
    assert set(s) == {2}


def test_time_guard_ignores_older_late_change(spark):
    rows = [(1, 10, 10.0, "I", 1), (1, 5, 5.0, "U", 2)]
    assert apply_batches(spark, rows)[1].v == 5.0          # parity: the late, older change wins
    assert apply_batches(spark, rows, time_guard=True)[1].v == 10.0


def test_null_condition_matches_nothing(spark):
    tgt = spark.createDataFrame([(1, "a")], "k long, x string")
    src = spark.createDataFrame([(1, "b", None), (2, "c", None)], "k long, x string, flag boolean")
    out = keyed_merge(tgt, src, ["k"], [Clause(DELETE, F.col("src.flag"))],
                      [Clause({"x": F.col("src.x")}, F.col("src.flag"))])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a")]


def test_bucketed_merge_equals_plain(spark):
    tgt = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    src = spark.range(150, 260).select(F.col("id").alias("k"), (F.col("id") * 3).alias("x"))
    clauses = dict(matched=[Clause({"x": F.col("src.x")})], not_matched=[Clause({"k": F.col("src.k"),
                                                                              "x": F.col("src.x")})])
    plain = keyed_merge(tgt, src, ["k"], **clauses)
    bt = tgt.withColumn("_bucket", bucket_of(["k"], 8))
    bs = src.withColumn("_bucket", bucket_of(["k"], 8))
    bucketed = keyed_merge(bt, bs, ["k"], bucket_col="_bucket", **clauses).drop("_bucket")
    assert sorted(plain.collect()) == sorted(bucketed.select(*plain.columns).collect())
    assert plain.count() == 260


def test_gold_merge_never_keeps_inactive(spark):
    tgt = spark.createDataFrame([(1, "a", True), (2, "b", True)], "id long, x string, is_active boolean")
    src = spark.createDataFrame([(1, "a2", False, True), (2, "b2", True, False), (3, "c", False, True),
                                 (4, "d", True, False)], "id long, x string, is_active boolean, gold_delete_flag boolean")
    out = {r.id: r.x for r in merge_fact(tgt, src, "id").collect()}
    assert out == {2: "b2", 4: "d"}


def test_snapshot_merge_is_idempotent_and_touches_one_date(spark):
    snap = spark.createDataFrame([("2024-01-02 00:00:00", 1, 5.0), ("2024-01-02 00:00:00", 2, 6.0)],
                                 "snapshot_ts string, opportunity_id long, v double") \
        .withColumn("snapshot_ts", F.to_timestamp("snapshot_ts")).withColumn("snapshot_date", F.to_date("snapshot_ts"))
    old = snap.withColumn("snapshot_ts", F.to_timestamp(F.lit("2024-01-01 00:00:00"))) \
        .withColumn("snapshot_date", F.to_date("snapshot_ts"))
    once = merge_snapshot(old, snap, ["snapshot_ts", "opportunity_id"])
    twice = merge_snapshot(once, snap, ["snapshot_ts", "opportunity_id"])
    assert once.count() == twice.count() == 4
    assert sorted(once.collect()) == sorted(twice.collect())


def test_duplicate_guard(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k long, s long")
    with pytest.raises(ValueError):
        ensure_unique(df, ["k"], "error")
    assert sorted(tuple(r) for r in ensure_unique(df, ["k"], "latest", ["s"]).collect()) == [(1, 2), (2, 1)]


def run_rows(spark, log, run):
    """One run's prepared changes of a small log."""
    ts = F.lit(run_ts_of(run)).cast("timestamp")
    return prepare_silver_source(latest_per_key(log_df(spark, log).drop("batch"), ["k"], silver_order(["seq"])), SPEC, f"r{run}", ts)


def test_a_run_adds_only_its_own_files(spark, scratch):
    from revflow.sources.deltas import state_table

    state = state_table(spark, f"{scratch}/state", SPEC)
    state.append(run_rows(spark, [(k, k, float(k), "I", 1) for k in range(40)], 1), "r1", 1)
    files = set(state.appended().inputFiles())
    state.append(run_rows(spark, [(3, 100, 0.0, "D", 2), (5, 101, 55.0, "U", 2)], 2), "r2", 2)
    cur = {r.k: r for r in state.read().collect()}
    assert len(cur) == 40 and not cur[3].is_active and cur[5].v == 55.0 and cur[7].v == 7.0
    assert files < set(state.appended().inputFiles())
    assert state.fold("k") == 2 and {r.k: r for r in state.read().collect()} == cur
    # a replayed run replaces its own rows; an order that is taken gives way to the next
    assert state.append(run_rows(spark, [(5, 101, 56.0, "U", 2)], 3), "r3", 1, replays=True) == 3
    assert state.append(run_rows(spark, [(5, 101, 57.0, "U", 2)], 3), "r3", 9, replays=True) == 3
    assert {r.k: r.v for r in state.read().collect()}[5] == 57.0
    gone = state_table(spark, f"{scratch}/state", SPEC, hard_delete=True)
    gone.append(run_rows(spark, [(k, 200 + k, 0.0, "D", 4) for k in range(40)], 4), "r4", 4)
    assert gone.read().count() == 0 and state.read().count() == 40


@pytest.mark.parametrize("hard,guard", [(False, False), (True, False), (False, True), (True, True)])
def test_fold_equals_merging_run_by_run(spark, scratch, hard, guard):
    """Random logs with late and repeated changes: the fold, with bases in between, gives what the keyed merge gives run after run."""
    import random

    from revflow.sources.deltas import state_table

    rng = random.Random(hard * 2 + guard)
    table = state_table(spark, f"{scratch}/t", SPEC, hard_delete=hard, time_guard=guard)
    target = None
    for run in range(1, 7):
        log = [(rng.randrange(12), rng.randrange(60), float(rng.randrange(100)), rng.choice("IUUD"), run) for _ in range(14)]
        rows = run_rows(spark, log, run)
        src = spark.createDataFrame(rows.collect(), rows.schema)
        table.append(src, f"r{run}", run)
        ts = F.lit(run_ts_of(run)).cast("timestamp")
        first = src.filter(~F.col("bronze_is_delete")).drop("bronze_is_delete")
        merged = first if target is None else merge_current_state(target, src, SPEC, f"r{run}", ts, time_guard=guard, hard_delete=hard)
        target = spark.createDataFrame(merged.collect(), merged.schema)
        if run in (2, 5):
            table.fold("k")
        got = table.read().select(*target.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, target.collect())), run


@pytest.mark.parametrize("hard", [False, True])
def test_feed_of_runs_equals_the_difference_of_two_states(spark, scratch, hard):
    """Random logs with deletes, revivals and late changes; every pair of marks, before and after the base."""
    import random

    from revflow.operators.diff import table_diff
    from revflow.operators.fold import fold_feed
    from revflow.sources.deltas import state_table

    rng = random.Random(5 + hard)
    table = state_table(spark, f"{scratch}/feed", SPEC, hard_delete=hard)
    states = {0: None}
    for run in range(1, 5):
        log = [(rng.randrange(9), rng.randrange(60), float(rng.randrange(9)), rng.choice("IUDD"), run) for _ in range(9)]
        table.append(run_rows(spark, log, run), f"r{run}", run)
        state = table.read()
        states[run] = spark.createDataFrame(state.collect(), state.schema)
        if run == 2:
            table.fold("k")
    compare, seen = ["v", "is_active", "silver_deleted_ts"], set()
    for after, upto in ((0, 1), (0, 4), (1, 3), (2, 3), (2, 4), (3, 4), (4, 9)):
        got = fold_feed(table.changes_at(after), SPEC, after, upto, compare, carry=["v", "is_active"], hard_delete=hard).collect()
        new = states[min(upto, 4)]
        want = table_diff(new.limit(0) if states[after] is None else states[after], new, ["k"], compare, carry=["v", "is_active"]).collect()
        assert sorted(map(str, got)) == sorted(map(str, want)), (after, upto)
        seen |= {r.change_type for r in got}
    assert seen == ({"insert", "update", "delete"} if hard else {"insert", "update"})
