"""Current state of an appended change log, folded on read.

A log row is one run's change of a key (at most one for each key and run) with ``_order``, the place of its run, or a row of a folded
base (``_state`` true). Folds are ``groupBy`` aggregates of the rows' structs: every run adds at most one row for a key, so a group is
bounded by the runs since the last base, however often a key changes within a run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revflow.spec import EntitySpec

ORDER, RUN, STATE = "_order", "_run", "_state"


def audit_columns(spec: EntitySpec) -> list[str]:
    """The columns that a delete changes in a stored row."""
    return [spec.active_flag_column, "silver_deleted_ts", "silver_last_event_ts", "silver_last_run_id", "silver_updated_ts"]


def _is_upsert() -> Column:
    return F.coalesce(F.col(STATE), F.lit(False)) | (F.col("bronze_is_delete") == F.lit(False))


def fold_current_state(changes: DataFrame, spec: EntitySpec, hard_delete: bool | None = None, time_guard: bool = False) -> DataFrame:
    """The state after merging (M1) every run's prepared rows in order; the same rows as ``merge_current_state`` run by run.

    The last upsert gives the attributes, the last change of all the audit columns; a key that was only ever deleted has no row.
    With ``hard_delete`` (X30) a key survives if its last change is an upsert. With ``time_guard`` (T4) a change older than the state it
    meets is ignored, which depends on what was applied before, so the changes of a key are applied one after the other.
    """
    hard = spec.delete_strategy == "hard_delete" if hard_delete is None else hard_delete
    key, audit = spec.primary_key, audit_columns(spec)
    steering = {key, ORDER, RUN, STATE, "bronze_is_delete"}
    attrs = [c for c in changes.columns if c not in steering and c not in audit]
    place = F.struct(ORDER, RUN)
    known = changes.filter(_is_upsert() | (F.col("bronze_is_delete") == F.lit(True)))
    gone = ~_is_upsert()
    if time_guard:
        return _guarded(known, spec, attrs, audit, hard)
    folded = known.groupBy(key).agg(
        F.max_by(F.when(~gone, F.struct(*attrs, *audit)), F.when(~gone, place)).alias("up"),
        F.max_by(F.struct(gone.alias("gone"), *audit), place).alias("last"))
    if hard:
        folded = folded.filter(~F.col("last.gone"))
    alive = folded.filter(F.col("up").isNotNull())
    return alive.select(key, *(F.col("up")[c].alias(c) for c in attrs), *(F.col("last")[c].alias(c) for c in audit))


def _guarded(known: DataFrame, spec: EntitySpec, attrs: Sequence[str], audit: Sequence[str], hard: bool) -> DataFrame:
    change = F.struct(F.struct(ORDER, RUN).alias("place"), (~_is_upsert()).alias("gone"), F.struct(*audit).alias("audit"), F.struct(*attrs).alias("attrs"))
    listed = known.groupBy(spec.primary_key).agg(F.collect_list(change).alias("changes"))
    in_order = F.array_sort("changes", lambda a, b: F.when(a["place"] < b["place"], -1).when(a["place"] > b["place"], 1).otherwise(0))
    kind = listed.schema["changes"].dataType.elementType
    nothing = F.lit(None).cast(kind)

    def apply(state: Column, row: Column) -> Column:
        older = state["audit"]["silver_last_event_ts"].isNotNull() & ~F.coalesce(
            row["audit"]["silver_last_event_ts"] >= state["audit"]["silver_last_event_ts"], F.lit(False))
        deleted = nothing if hard else F.struct(row["place"].alias("place"), row["gone"].alias("gone"), row["audit"].alias("audit"), state["attrs"].alias("attrs"))
        return (F.when(state.isNull(), F.when(~row["gone"], row))
                .when(older, state).when(row["gone"], deleted).otherwise(row))

    folded = listed.select(spec.primary_key, F.aggregate(in_order, nothing, apply).alias("s")).filter(F.col("s").isNotNull())
    return folded.select(spec.primary_key, *(F.col("s.attrs")[c].alias(c) for c in attrs), *(F.col("s.audit")[c].alias(c) for c in audit))


def fold_increment(changes: DataFrame, spec: EntitySpec, after: Column) -> DataFrame:
    """the state's rows that changed after ``after`` (strict), from the changes since then.

    A run's order is never before the time it stamps on its rows, so older runs' partitions are pruned. Only for keys that were
    deleted and not written since then the older rows are looked up, for their attributes.
    """
    key = spec.primary_key
    new = changes.filter((F.col("silver_updated_ts") > after) & (F.col(STATE) | (F.col(ORDER) > F.unix_micros(after))))
    only_deleted = new.groupBy(key).agg(F.max(_is_upsert()).alias("written")).filter(~F.coalesce("written", F.lit(False))).select(key)
    old = changes.filter(F.col("silver_updated_ts") <= after).join(only_deleted, key, "left_semi")
    return fold_current_state(new.unionByName(old), spec).filter(F.col("silver_updated_ts") > after)


def fold_feed(changes: DataFrame, spec: EntitySpec, after: int, upto: int, compare: Sequence[str], carry: Sequence[str] = (),
              hard_delete: bool | None = None) -> DataFrame:
    """What the runs with an order in (``after``, ``upto``] did to the state: insert, update and delete rows as ``table_diff`` of the states at both.

    Only these runs' changes are read whole (their partitions are selected by order). Of older rows those of the same keys are kept, for
    the state before, so what is shuffled grows with the changes and not with the table. Both states come from one aggregation.
    """
    hard = spec.delete_strategy == "hard_delete" if hard_delete is None else hard_delete
    key, audit = spec.primary_key, audit_columns(spec)
    wanted = list(dict.fromkeys([*compare, *carry]))
    changes = changes.select(key, ORDER, RUN, STATE, "bronze_is_delete", *(c for c in wanted if c != key))
    new = changes.filter((F.col(ORDER) > after) & (F.col(ORDER) <= upto))
    old = changes.filter(F.col(ORDER) <= after).join(new.select(key).distinct(), key, "left_semi")
    known = old.unionByName(new).filter(_is_upsert() | (F.col("bronze_is_delete") == F.lit(True)))
    place, values = F.struct(ORDER, RUN), F.struct(*wanted)
    folds = []
    for name, within in (("old", F.col(ORDER) <= after), ("new", F.lit(True))):
        folds += [F.max_by(values, F.when(within & _is_upsert(), place)).alias(f"{name}_up"),
                  F.max_by(F.struct((~_is_upsert()).alias("gone"), values.alias("row")), F.when(within, place)).alias(f"{name}_last")]
    folded = known.groupBy(key).agg(*folds)

    def there(name: str) -> Column:
        up = F.col(f"{name}_up").isNotNull()
        return up & ~F.col(f"{name}_last.gone") if hard else up

    def value(name: str, c: str) -> Column:
        held = F.col(f"{name}_last.row")[c] if c in audit else F.col(f"{name}_up")[c]
        return F.when(there(name), held)

    differ = F.lit(False)
    for c in compare:
        differ = differ | ~value("old", c).eqNullSafe(value("new", c))
    kind = (F.when(~there("old") & there("new"), F.lit("insert")).when(there("old") & ~there("new"), F.lit("delete"))
            .when(there("old") & there("new") & differ, F.lit("update")))
    out = folded.withColumn("change_type", kind).filter(F.col("change_type").isNotNull())
    return out.select(key, "change_type", *(value("old", c).alias(f"old_{c}") for c in carry), *(value("new", c).alias(f"new_{c}") for c in carry))


def fold_fact(changes: DataFrame, key: str) -> DataFrame:
    """M2 / M3 over every run's flagged fact rows in order: the last row of a key, unless it is flagged as deleted."""
    columns = [c for c in changes.columns if c not in (key, ORDER, RUN, STATE, "gold_delete_flag")]
    known = changes.filter(F.col("gold_delete_flag").isNotNull() | F.coalesce(F.col(STATE), F.lit(False)))
    last = F.struct(*columns, F.coalesce("gold_delete_flag", F.lit(False)).alias("gone"))
    folded = known.groupBy(key).agg(F.max_by(last, F.struct(ORDER, RUN)).alias("last")).filter(~F.col("last.gone"))
    return folded.select(key, *(F.col("last")[c].alias(c) for c in columns))


def fold_activity(changes: DataFrame) -> DataFrame:
    """M3 over two sources: the last row of each id and kind, deleted ones too, as a kind's delete only ends what that kind said."""
    keys = ("activity_id", "activity_type")
    columns = [c for c in changes.columns if c not in (*keys, ORDER, RUN, STATE)]
    folded = changes.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(ORDER, RUN)).alias("last"))
    return folded.select(*keys, *(F.col("last")[c].alias(c) for c in columns))


def newest_kind(rows: DataFrame) -> DataFrame:
    """One row for each activity id: the kind that changed it last (event time, then silver's time, then kind), unless deleted."""
    columns = [c for c in rows.columns if c != "activity_id"]
    last = rows.groupBy("activity_id").agg(
        F.max_by(F.struct(*columns), F.struct("source_event_ts", "gold_source_updated_ts", "activity_type")).alias("last"))
    last = last.filter(~F.coalesce(F.col("last.gold_delete_flag"), F.lit(False)))
    return last.select("activity_id", *(F.col("last")[c].alias(c) for c in columns if c != "gold_delete_flag"))
