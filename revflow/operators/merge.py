"""Keyed merge over DataFrames.

``keyed_merge`` evaluates MERGE-style clauses with one full outer join: each
output row takes the first clause whose condition holds (a NULL condition does
not hold), a ``delete`` action removes the row, target rows without a source
partner pass unchanged and source rows without a matching clause are dropped.

Scale: the join shuffles both sides on the key. When both sides carry a bucket
column (``pmod(xxhash64(key), B)``, stored as the table's partition column),
only target buckets touched by the source enter the join; the touched-bucket
set has at most B rows, a proven bound, so it is broadcast, and untouched
rows flow through a narrow filter without any exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revflow.spec import EntitySpec

_T, _S, _ACT = "__tgt_present", "__src_present", "__merge_action"
DELETE = "delete"
UPDATE_ALL = "update_all"
INSERT_ALL = "insert_all"
BUCKET = "_bucket"


@dataclass
class Clause:
    """One WHEN clause. ``action`` is ``delete``, ``update_all``/``insert_all`` or a
    {column: Column} assignment; expressions use ``src.<c>`` and ``tgt.<c>``."""

    action: str | Mapping[str, Column]
    condition: Column | None = None
    extra: dict = field(default_factory=dict)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Stable hash bucket of a key, used as the state table's partition column."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _src(c: str) -> Column:
    return F.col(f"src.{c}")


def _tgt(c: str) -> Column:
    return F.col(f"tgt.{c}")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _merge_core(target: DataFrame, source: DataFrame, keys: Sequence[str],
                matched: Sequence[Clause], not_matched: Sequence[Clause]) -> DataFrame:
    tgt_types = {f.name: f.dataType.simpleString() for f in target.schema.fields}  # one schema round trip
    cols = list(tgt_types)
    src_cols = set(source.columns)
    t = target.withColumn(_T, F.lit(True)).alias("tgt")
    s = source.withColumn(_S, F.lit(True)).alias("src")
    cond = None
    for k in keys:
        c = _tgt(k) == _src(k)
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    is_m = _tgt(_T).isNotNull() & _src(_S).isNotNull()
    is_nm = _tgt(_T).isNull() & _src(_S).isNotNull()
    clauses = [(is_m, cl) for cl in matched] + [(is_nm, cl) for cl in not_matched]
    act = None
    for i, (scope, cl) in enumerate(clauses):
        ok = scope if cl.condition is None else scope & F.coalesce(cl.condition, F.lit(False))
        act = F.when(ok, F.lit(i)) if act is None else act.when(ok, F.lit(i))
    # -1: target-only row (kept as is); -2: source row that no clause took (dropped)
    fallback = F.when(_tgt(_T).isNotNull(), F.lit(-1)).otherwise(F.lit(-2))
    act = fallback if act is None else act.otherwise(fallback)
    deleting = [i for i, (_, cl) in enumerate(clauses) if cl.action == DELETE] + [-2]
    # Assigned expressions become helper columns; the per-column CASE over the
    # chosen clause is then stated as SQL text in one projection (one round trip).
    helpers, cases = [], []
    for c in cols:
        branches = []
        for i, (_, cl) in enumerate(clauses):
            if cl.action == DELETE:
                continue
            if cl.action in (UPDATE_ALL, INSERT_ALL):
                v = f"src.{_q(c)}" if c in src_cols else "NULL"
            elif c in cl.action:
                h = f"__v{i}_{len(helpers)}"
                helpers.append(cl.action[c].alias(h))
                v = _q(h)
            elif _scope_is_insert(cl, not_matched):
                v = "NULL"
            else:
                continue  # a matched clause that does not assign c keeps the target value
            branches.append(f"WHEN {i} THEN {v}")
        base = f"tgt.{_q(c)}"
        expr = f"CASE {_q(_ACT)} {' '.join(branches)} ELSE {base} END" if branches else base
        cases.append(f"CAST({expr} AS {tgt_types[c]}) AS {_q(c)}")
    j = j.select("*", act.alias(_ACT), *helpers).filter(~F.col(_ACT).isin(deleting))
    return j.selectExpr(*cases)


def _scope_is_insert(cl: Clause, not_matched: Sequence[Clause]) -> bool:
    return any(cl is x for x in not_matched)


def keyed_merge(target: DataFrame, source: DataFrame, keys: Sequence[str],
                matched: Sequence[Clause] = (), not_matched: Sequence[Clause] = (),
                bucket_col: str | None = None, touched_only: bool = False) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``; returns the new target.

    ``source`` must be unique on ``keys`` (see ``dedup.ensure_unique``). With
    ``bucket_col`` present on both sides, only the touched buckets are joined;
    ``touched_only`` returns just those buckets (for a partition overwrite).
    """
    if bucket_col and bucket_col in target.columns and bucket_col in source.columns:
        touched = F.broadcast(source.select(bucket_col).distinct())
        hot = target.join(touched, bucket_col, "left_semi")
        merged = _merge_core(hot, source, [bucket_col, *keys], matched, not_matched)
        if touched_only:
            return merged
        rest = target.join(touched, bucket_col, "left_anti")
        return merged.unionByName(rest)
    return _merge_core(target, source, keys, matched, not_matched)


# --- the pipeline's merges ------------------------------------------------

#: Columns that steer a merge and are never stored.
STEERING = ("gold_delete_flag", "bronze_is_delete")


def with_new_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """``target`` with the source's added columns as typed NULLs, so that a merge carries them on."""
    have = set(target.columns)
    new = {f.name: F.lit(None).cast(f.dataType) for f in source.schema.fields if f.name not in have and f.name not in STEERING}
    return target.withColumns(new) if new else target


def prepare_silver_source(valid: DataFrame, spec: EntitySpec, run_id: str | Column, run_ts: Column | None = None) -> DataFrame:
    """P4-P6 on a deduplicated batch: active flag, deleted time and audit stamp."""
    run_ts = run_ts if run_ts is not None else F.current_timestamp()
    is_del = F.col("bronze_is_delete") == F.lit(True)
    return valid.withColumns(
        {
            spec.active_flag_column: F.when(is_del, F.lit(False)).otherwise(F.lit(True)),
            "silver_deleted_ts": F.when(is_del, F.coalesce(F.col("bronze_business_event_ts"), run_ts)).otherwise(
                F.lit(None).cast("timestamp")
            ),
            "silver_last_event_ts": F.col("bronze_business_event_ts"),
            "silver_last_run_id": F.lit(run_id),  # a column stays what it is
            "silver_updated_ts": run_ts.cast("timestamp"),
        }
    )


def merge_current_state(target: DataFrame, source: DataFrame, spec: EntitySpec, run_id: str,
                        run_ts: Column | None = None, time_guard: bool = False,
                        hard_delete: bool | None = None, bucket_col: str | None = None,
                        touched_only: bool = False) -> DataFrame:
    """M1 (soft delete) or X30 (hard delete) of a prepared, deduplicated batch.

    (a) matched delete: only the active flag, deleted time and audit columns
    change; (b) matched upsert: every column from the source, revived;
    (c) unmatched upsert: insert. A delete for an unknown key inserts nothing.
    ``time_guard`` (T4) ignores source rows older than the stored event time.
    """
    run_ts = run_ts if run_ts is not None else F.current_timestamp()
    active = spec.active_flag_column
    hard = spec.delete_strategy == "hard_delete" if hard_delete is None else hard_delete
    src_del = _src("bronze_is_delete") == F.lit(True)
    src_up = _src("bronze_is_delete") == F.lit(False)
    guard = None
    if time_guard:
        guard = _tgt("silver_last_event_ts").isNull() | (
            _src("bronze_business_event_ts") >= _tgt("silver_last_event_ts"))
    target = with_new_columns(target, source)
    cols = target.columns
    src_cols = set(source.columns)
    upsert = {c: (_src(c) if c in src_cols else F.lit(None)) for c in cols}
    upsert.update({active: F.lit(True), "silver_deleted_ts": F.lit(None), "silver_updated_ts": run_ts})
    if hard:
        on_delete = Clause(DELETE, src_del if guard is None else src_del & guard)
    else:
        on_delete = Clause(
            {
                active: F.lit(False),
                "silver_deleted_ts": F.coalesce(_src("bronze_business_event_ts"), run_ts),
                "silver_last_event_ts": _src("bronze_business_event_ts"),
                "silver_last_run_id": F.lit(run_id),
                "silver_updated_ts": run_ts,
            },
            src_del if guard is None else src_del & guard,
        )
    matched = [on_delete, Clause(upsert, src_up if guard is None else src_up & guard)]
    not_matched = [Clause(upsert, src_up)]
    return keyed_merge(target, source, [spec.primary_key], matched, not_matched, bucket_col=bucket_col,
                       touched_only=touched_only)


def silver_schema_frame(source: DataFrame) -> DataFrame:
    """An empty target with the prepared source's schema, minus the delete flag."""
    return source.drop("bronze_is_delete").limit(0)


def merge_fact(target: DataFrame, facts: DataFrame, business_key: str, bucket_col: str | None = None,
               touched_only: bool = False) -> DataFrame:
    """M2 / M3: delete on a flagged match, update all on an unflagged match,
    insert unflagged new keys. ``facts`` carries ``gold_delete_flag``."""
    flag = _src("gold_delete_flag") == F.lit(True)
    unflag = _src("gold_delete_flag") == F.lit(False)
    return keyed_merge(
        with_new_columns(target, facts), facts, [business_key],
        matched=[Clause(DELETE, flag), Clause(UPDATE_ALL, unflag)],
        not_matched=[Clause(INSERT_ALL, unflag)],
        bucket_col=bucket_col, touched_only=touched_only,
    )


def merge_snapshot(target: DataFrame, snap: DataFrame, keys: Sequence[str], touched_only: bool = False) -> DataFrame:
    """M4: idempotent upsert on (snapshot_ts, business key); never deletes.

    Only the snapshot dates present in ``snap`` are joined (a bounded set of
    dates, broadcast); other dates pass through untouched.
    """
    target = with_new_columns(target, snap)
    dates = F.broadcast(snap.select("snapshot_date").distinct())
    hot = target.join(dates, "snapshot_date", "left_semi")
    rest = target.join(dates, "snapshot_date", "left_anti")
    merged = _merge_core(hot, snap, keys,
                         [Clause(UPDATE_ALL)], [Clause(INSERT_ALL)])
    return merged if touched_only else merged.unionByName(rest)
