"""Bronze -> silver -> gold as DataFrame plans (batch form of each stage).

The streaming form of bronze lives in ``revflow.streaming``; the stateful
jobs that persist versions and control tables live in ``revflow.jobs``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revflow.functions.cdc import classify_changes, stamp_lineage, standardize_event_time
from revflow.functions.quality import apply_entity_rules, build_bad_records, split_valid_invalid
from revflow.operators.dedup import ensure_unique, latest_per_key, silver_order
from revflow.operators.merge import merge_current_state, prepare_silver_source, silver_schema_frame
from revflow.operators.fold import ORDER, RUN
from revflow.sources.deltas import ChangeTable
from revflow.spec import EntitySpec


def bronze_rows(feed: DataFrame, spec: EntitySpec, run_id: str, ingest_ts: Column | None = None,
                source_file: Column | None = None) -> DataFrame:
    """P1 + P2 on a batch of change rows."""
    if source_file is None:
        source_file = F.lit(None).cast("string")
    return stamp_lineage(classify_changes(feed, spec), spec, run_id, ingest_ts, source_file)


#: Days that the date of an instant can differ between the zones of two sessions.
ZONE_DAYS = 2


def silver_increment(bronze: DataFrame, watermark=None, backfill: tuple | None = None) -> DataFrame:
    """Rows newer than the watermark (strict), or inside a backfill window
    ``[from, to)`` which replaces the watermark filter.

    When bronze is partitioned by ``ingestion_date`` the implied date bounds are
    added as well, so partitions before the watermark are pruned, not scanned.
    """
    ts = F.col("bronze_ingest_ts")
    dated = "ingestion_date" in bronze.columns
    if backfill is not None:
        lo, hi = (F.lit(x).cast("timestamp") for x in backfill)
        cond = (ts >= lo) & (ts < hi)
        if dated:
            cond = cond & (F.col("ingestion_date") >= F.date_sub(lo, ZONE_DAYS)) & (F.col("ingestion_date") <= F.date_add(hi, ZONE_DAYS))
        return bronze.filter(cond)
    if watermark is not None:
        wm = F.lit(watermark).cast("timestamp")
        cond = ts > wm
        if dated:
            cond = cond & (F.col("ingestion_date") >= F.date_sub(wm, ZONE_DAYS))
        return bronze.filter(cond)
    return bronze


def checked(bronze: DataFrame, spec: EntitySpec, deletes_exempt: bool = True) -> DataFrame:
    """P3 + D1-D4: event time and ``dq_failure_reasons``."""
    df = standardize_event_time(bronze, spec.event_time_column)
    return apply_entity_rules(df, spec.mandatory_columns, spec.non_negative_columns, spec.primary_key,
                              deletes_exempt=deletes_exempt)


def silver_source(bronze: DataFrame, spec: EntitySpec, run_id: str, run_ts: Column | None = None,
                  tie_breakers: Sequence[str | Column] = (), deletes_exempt: bool = True,
                  quarantined_ts: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """One silver increment: (prepared merge source, bad records).

    Invalid rows leave before dedup, so an older valid row beats a newer
    invalid one.
    """
    rows = checked(bronze, spec, deletes_exempt)
    bad = bad_rows(rows, spec, run_id, quarantined_ts if quarantined_ts is not None else run_ts)
    return valid_changes(rows, spec, run_id, run_ts, tie_breakers), bad


def bad_rows(rows: DataFrame, spec: EntitySpec, run_id: str, quarantined_ts: Column | None) -> DataFrame:
    """The quarantine rows (D5) of checked rows."""
    return build_bad_records(split_valid_invalid(rows)[1], run_id, spec.name, "silver", spec.primary_key, quarantined_ts)


def valid_changes(rows: DataFrame, spec: EntitySpec, run_id: str, run_ts: Column | None = None,
                  tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """W1 + P4-P6: one prepared change for each key of checked rows."""
    valid = split_valid_invalid(rows)[0]
    if spec.dedup_enabled:
        valid = latest_per_key(valid, [spec.primary_key], silver_order(tie_breakers))
    else:
        valid = ensure_unique(valid, [spec.primary_key], "error")
    return prepare_silver_source(valid, spec, run_id, run_ts)


def silver_merge(target: DataFrame | None, source: DataFrame, spec: EntitySpec, run_id: str,
                 run_ts: Column | None = None, **kw) -> DataFrame:
    """M1 into ``target``. Without a target (first run) only clause (c) can fire,
    so the bootstrap is the source's upserts, with the target's column set."""
    if target is None:
        return (source.filter(F.col("bronze_is_delete") == F.lit(False))
                .select(*silver_schema_frame(source).columns))
    return merge_current_state(target, source, spec, run_id, run_ts, **kw)


def silver_state_of_feed(feed: DataFrame, spec: EntitySpec, run_id: str, run_ts: Column,
                         tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """A whole feed as one bronze batch merged into an empty silver table."""
    bronze = bronze_rows(feed, spec, run_id, run_ts)
    source, _ = silver_source(bronze, spec, run_id, run_ts, tie_breakers)
    return silver_merge(None, source, spec, run_id, run_ts)


def append_batches(table: ChangeTable, valid: DataFrame, spec: EntitySpec, batch_col: str, run_id_of: Callable[[Column], Column],
                   run_ts_of: Callable[[Column], Column], tie_breakers: Sequence[str | Column] = ()) -> None:
    """The incremental path of many batches at once: append the changes of every batch to ``table`` as its own run.

    Each batch's dedup is independent of the others, so the winners of all (key, batch) pairs are found by one window (a partial top-1
    before the shuffle) and written in one job, one partition of the change log for each batch. Batches are ordered by their run time.
    ``run_id_of`` / ``run_ts_of`` map the batch column to its run id and run time.
    """
    winners = latest_per_key(valid, [spec.primary_key, batch_col], silver_order(tie_breakers))
    run_id, run_ts = run_id_of(F.col(batch_col)), run_ts_of(F.col(batch_col))
    rows = winners.withColumns({ORDER: F.unix_micros(run_ts), RUN: run_id})
    table.append_runs(prepare_silver_source(rows, spec, run_id, run_ts).drop(batch_col))
