"""Runs of the medallion flow over a workspace folder, with control tables.

A workspace is one shared folder (a path on the cluster's shared storage):

    bronze/<entity>/            parquet appended by the stream, partitioned by ingestion_date
    silver/<entity>/            each run's changes, appended; the current state is their fold (sources.deltas)
    gold/<fact>/                each run's fact rows, appended; the active facts are their fold
    gold/fact_pipeline_snapshot/  snapshots by snapshot_date; a run overwrites its own date's partition only
    schemas/<entity>/           the feed's schema history (sources.schemas)
    control/run_registry        append-only run events (folded on read)
    control/pipeline_watermark  append-only watermark rows (latest is current)
    control/bad_records         quarantined rows, partitioned by entity_name

Every run logs start and end events, reads increments strictly after its
layer's watermark, appends its changes and then moves the watermark; what it
writes is proportional to its increment, and its counts and marks are observed
while it is written. A crash before the watermark moves repeats the increment;
merging a change twice changes nothing, and quarantine ids are content
hashes without the run, so nothing is doubled. A backfill never lowers a
watermark and never overwrites newer rows. Watermarks are texts in UTC and are
compared as instants, so sessions of any zone can share a workspace.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from revflow.functions.quality import REASONS, new_bad_records
from revflow.operators import control
from revflow.operators.facts import activity_rows, build_fact_rows
from revflow.operators.fold import fold_increment
from revflow.operators.snapshot import build_snapshot, store_snapshot, stored_snapshots
from revflow.plans import marts
from revflow.plans.medallion import bad_rows, checked, silver_increment, valid_changes
from revflow.sources.deltas import ChangeTable, activity_table, fact_table, state_table
from revflow.sources.files import append
from revflow.sources.schemas import SchemaStore
from revflow.sources.views import publish_view
from revflow.spec import APPOINTMENT, ENTITIES, OPPORTUNITY, PHONECALL, EntitySpec
from revflow.streaming.cdc import micros
from revflow.streaming.ingest import bronze_stream, read_feed_stream, start_bronze_sink


def utcnow() -> datetime:
    return datetime.now(timezone.utc)


def _utc(t: datetime | None) -> datetime:
    """A run's clock: now, or a given time; one without a zone is UTC."""
    return utcnow() if t is None else t if t.tzinfo else t.replace(tzinfo=timezone.utc)


@dataclass
class Workspace:
    spark: SparkSession
    root: str
    hints: dict[str, T.StructType] = field(default_factory=dict)  # declared columns of an entity's feed

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def bronze(self, entity: str) -> DataFrame:
        """The bronze rows, in the feed's current schema where the store discovered it."""
        store, path = self.schemas(entity), self.path("bronze", entity)
        if store.schema() is None:
            return self.spark.read.option("mergeSchema", "true").parquet(path)
        return store.current_rows(path)

    def silver(self, entity: str) -> ChangeTable:
        return state_table(self.spark, self.path("silver", entity), ENTITIES[entity], self.schemas(entity).generation())

    def gold(self, fact: str) -> ChangeTable:
        if fact == "fact_activity":
            return activity_table(self.spark, self.path("gold", fact), max(self.schemas(s.name).generation() for s in (PHONECALL, APPOINTMENT)))
        entity = fact.removeprefix("fact_")
        return fact_table(self.spark, self.path("gold", fact), ENTITIES[entity].business_key, self.schemas(entity).generation())

    def snapshots(self) -> DataFrame | None:
        return stored_snapshots(self.spark, self.path("gold", "fact_pipeline_snapshot"))

    def schemas(self, entity: str) -> SchemaStore:
        return SchemaStore(self.spark, self.path("schemas", entity), self.hints.get(entity))

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self.path("control", name))
        except AnalysisException:
            return control.empty(self.spark, schema)

    def runs(self) -> DataFrame:
        """Current run registry (fold of its events)."""
        return control.fold_runs(self._read("run_registry", control.RUN_REGISTRY_SCHEMA))

    def watermarks(self) -> DataFrame:
        return control.mark_current(self._read("pipeline_watermark", control.WATERMARK_SCHEMA))

    def bad_records(self) -> DataFrame:
        return self._read("bad_records", control.BAD_RECORDS_SCHEMA)

    # -- control writes (one small row each) --
    def log(self, df: DataFrame) -> None:
        append(df, self.path("control", "run_registry"))

    def set_watermark(self, entity: str, layer: str, wm_type: str, value: str, run_id: str, now: datetime) -> None:
        v = value
        append(control.watermark_event(self.spark, entity, layer, wm_type, v, run_id, now),
               self.path("control", "pipeline_watermark"))

    def watermark(self, entity: str, layer: str) -> str | None:
        events = self._read("pipeline_watermark", control.WATERMARK_SCHEMA)
        return control.latest_watermark(events, entity, layer)


def mark_text(us: int) -> str:
    """An instant, in microseconds since 1970, as a watermark: a UTC text of one length, so that later is also greater."""
    return f"{datetime(1970, 1, 1) + timedelta(microseconds=us):%Y-%m-%d %H:%M:%S.%f}"


def mark_time(mark: str) -> Column:
    """The instant of a watermark text, whatever the session's zone."""
    return F.timestamp_micros(F.lit(micros(datetime.fromisoformat(mark))))


def _start(ws: Workspace, run_id: str, pipeline: str, entity: str, layer: str, now: datetime,
           trigger_type: str = "scheduled", attempt: int = 1, parent: str | None = None) -> None:
    ws.log(control.run_start_event(ws.spark, run_id, parent, pipeline, entity, layer, trigger_type, attempt, now))


def _end(ws: Workspace, run_id: str, now: datetime, **kw) -> None:
    ws.log(control.run_end_event(ws.spark, run_id, now, **kw))


def _guard(ws: Workspace, run_id: str, fn):
    try:
        return fn()
    except Exception as e:  # log_failure, then re-raise
        _end(ws, run_id, utcnow(), status="failed", error_message=str(e))
        raise


# --- bronze -----------------------------------------------------------------

def run_bronze(ws: Workspace, spec: EntitySpec, landing: str, schema: T.StructType | None, run_id: str,
               trigger_mode: str = "available_now", fmt: str = "parquet", now: datetime | None = None,
               interval: str | None = None):
    """Stream new change files into the bronze table.

    Without a ``schema`` the store discovers it from the landed files and keeps its history (S2, S5): each run looks at the landed
    files first, so a file with a new or widened column restarts the stream with the evolved schema.

    ``available_now`` ingests what has landed, stops, logs the run and returns
    the rows it wrote, as the query counted them (F6, A4). ``micro_batch`` starts a continuously running query
    and returns its handle; progress is then in the query's own metrics.
    """
    now = _utc(now)
    _start(ws, run_id, f"crm_bronze_{spec.name}", spec.name, "bronze", now)

    def body():
        if schema is None:
            raw = ws.schemas(spec.name).read_stream(landing, fmt)
        else:
            raw = read_feed_stream(ws.spark, landing, schema, fmt)
        bronze = bronze_stream(raw, spec, run_id)
        q = start_bronze_sink(bronze, ws.path("bronze", spec.name), ws.path("_checkpoints", "bronze", spec.name),
                              trigger_mode, interval)
        if trigger_mode != "available_now":
            return q
        q.awaitTermination()
        written = sum(p["numInputRows"] for p in q.recentProgress)
        end = utcnow()
        mark = mark_text(micros(end))
        _end(ws, run_id, end, source_high_watermark=mark, source_row_count=written,
             target_row_count=written, rows_quarantined=0)
        ws.set_watermark(spec.name, "bronze", "source_high_watermark", mark, run_id, end)
        return written

    return _guard(ws, run_id, body)


# --- silver -----------------------------------------------------------------

def _not_older(changes: DataFrame, state: DataFrame | None, key: str) -> DataFrame:
    """T4: without the changes that are older than the state they would change."""
    if state is None:
        return changes
    stored = state.select(F.col(key).alias("__key"), F.col("silver_last_event_ts").alias("__event"))
    joined = changes.join(stored, F.col(key) == F.col("__key"), "left")
    newer = F.coalesce(F.col("bronze_business_event_ts") >= F.col("__event"), F.lit(False))
    return joined.filter(F.col("__event").isNull() | newer).select(*changes.columns)


def run_silver(ws: Workspace, spec: EntitySpec, run_id: str, now: datetime | None = None,
               backfill: tuple | None = None, time_guard: bool = False) -> str:
    """One silver increment; returns the run status.

    Bronze is read once: the checked increment is kept for the two writes, and its counts and high mark are observed by the first.
    """
    now = _utc(now)
    _start(ws, run_id, f"crm_silver_{spec.name}", spec.name, "silver", now)

    def body():
        run_ts = F.timestamp_micros(F.lit(micros(now)))
        bronze = ws.bronze(spec.name)
        mark = ws.watermark(spec.name, "silver")
        inc = silver_increment(bronze, mark_time(mark) if mark and not backfill else None, backfill)
        table, seen = ws.silver(spec.name), Observation()
        kept = checked(inc, spec).persist()
        try:
            rows = kept.observe(seen, F.count(F.lit(1)).alias("n"), F.unix_micros(F.max("bronze_ingest_ts")).alias("high"),
                                F.count_if(F.size(REASONS) > 0).alias("bad"))
            changes = valid_changes(rows, spec, run_id, run_ts)
            if time_guard or backfill is not None:
                changes = _not_older(changes, table.read(), spec.primary_key)
            table.append(changes, run_id, micros(now))
            stats = seen.get
            if not stats.get("n"):
                _end(ws, run_id, utcnow(), status="skipped")
                return "skipped"
            n_bad = stats["bad"]
            if n_bad and spec.quarantine_enabled:
                stored = ws.bad_records().filter(F.col("entity_name") == spec.name)  # one partition
                append(new_bad_records(bad_rows(kept, spec, run_id, run_ts), stored), ws.path("control", "bad_records"), ["entity_name"])
        finally:
            kept.unpersist()
        high = mark_text(stats["high"] if stats["high"] is not None else micros(now))  # A3 over every row read, valid or not
        high = max(high, mark or high)  # a backfill never lowers the mark
        status = "partial_success" if n_bad else "success"
        _end(ws, run_id, utcnow(), status=status, source_high_watermark=high, source_row_count=stats["n"],
             target_row_count=stats["n"] - n_bad, rows_quarantined=n_bad)
        ws.set_watermark(spec.name, "silver", "bronze_ingest_ts", high, run_id, utcnow())
        return status

    return _guard(ws, run_id, body)


# --- gold -------------------------------------------------------------------

def _silver_increment(ws: Workspace, entity: str, mark: str | None) -> DataFrame | None:
    """silver rows updated after the gold watermark, from the changes appended since then (older partitions are pruned)."""
    table = ws.silver(entity)
    if mark is None:
        return table.read()
    changes = table.changes()
    return None if changes is None else fold_increment(changes, ENTITIES[entity], mark_time(mark))


def _counted(rows: DataFrame, seen: Observation) -> DataFrame:
    """``rows`` with their number, how many are active and the latest silver time observed."""
    return rows.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(~F.col("gold_delete_flag")).alias("active"),
                        F.unix_micros(F.max("gold_source_updated_ts")).alias("high"))


def run_gold(ws: Workspace, spec: EntitySpec, run_id: str, now: datetime | None = None) -> str:
    """Append the silver increment's rows to the entity's fact, in one pass that also counts them."""
    now = _utc(now)
    _start(ws, run_id, f"crm_gold_{spec.name}", spec.name, "gold", now)

    def body():
        inc = _silver_increment(ws, spec.name, ws.watermark(spec.name, "gold"))
        if inc is None:
            _end(ws, run_id, utcnow(), status="skipped")
            return "skipped"
        seen, fact = Observation(), ws.gold(f"fact_{spec.name}")
        rows = build_fact_rows(inc, spec, F.timestamp_micros(F.lit(micros(now))))
        fact.append(_counted(rows, seen), run_id, micros(now))
        stats = seen.get
        if not stats.get("n"):
            _end(ws, run_id, utcnow(), status="skipped")
            return "skipped"
        if spec.serving_view:
            publish_view(fact.read(), spec.serving_view)
        high = mark_text(stats["high"] if stats["high"] is not None else micros(now))
        _end(ws, run_id, utcnow(), source_high_watermark=high, source_row_count=stats["n"],
             target_row_count=stats["active"], rows_quarantined=0)
        ws.set_watermark(spec.name, "gold", "silver_updated_ts", high, run_id, utcnow())
        return "success"

    return _guard(ws, run_id, body)


def run_activity(ws: Workspace, run_id: str, now: datetime | None = None) -> str:
    """The increments of both activity kinds, each after its own watermark, appended to fact_activity as one run.

    A kind's deletes travel as flagged rows. Only changed activities are read; the fold equals a full refresh.
    """
    now = _utc(now)
    _start(ws, run_id, "crm_gold_activity", "activity", "gold", now)

    def body():
        rows, seen = None, {}
        for spec in (PHONECALL, APPOINTMENT):
            inc = _silver_increment(ws, spec.name, ws.watermark(f"activity_{spec.name}", "gold"))
            if inc is None:
                continue  # a kind without a silver table yet has no rows; the other kind is built all the same
            seen[spec.name] = Observation()
            kind = _counted(activity_rows(inc, spec.activity_type or spec.name, F.timestamp_micros(F.lit(micros(now)))), seen[spec.name])
            rows = kind if rows is None else rows.unionByName(kind)
        if rows is None:
            _end(ws, run_id, utcnow(), status="skipped")
            return "skipped"
        fact = ws.gold("fact_activity")
        fact.append(rows, run_id, micros(now))
        stats = {k: o.get for k, o in seen.items()}
        read = sum(s.get("n") or 0 for s in stats.values())
        publish_view(fact.read(), PHONECALL.serving_view)
        mark = mark_text(micros(now))
        _end(ws, run_id, utcnow(), source_high_watermark=mark, source_row_count=read,
             target_row_count=sum(s.get("active") or 0 for s in stats.values()), rows_quarantined=0)
        for kind, s in stats.items():
            if s.get("n"):
                ws.set_watermark(f"activity_{kind}", "gold", "silver_updated_ts", mark_text(s["high"]), run_id, utcnow())
        ws.set_watermark("activity", "gold", "run_timestamp", mark, run_id, utcnow())
        return "success"

    return _guard(ws, run_id, body)


def run_snapshot(ws: Workspace, snapshot_ts: str, run_id: str, spec: EntitySpec = OPPORTUNITY,
                 now: datetime | None = None) -> str:
    """An idempotent snapshot of the current opportunity fact."""
    now = _utc(now)
    _start(ws, run_id, "crm_gold_pipeline_snapshot", spec.name, "gold_snapshot", now)

    def body():
        fact = ws.gold(f"fact_{spec.name}").read()
        if fact is None:
            _end(ws, run_id, utcnow(), status="skipped")
            return "skipped"
        seen, path = Observation(), ws.path("gold", "fact_pipeline_snapshot")
        snap = build_snapshot(fact.observe(seen, F.count(F.lit(1)).alias("n")), snapshot_ts, run_id, spec, F.timestamp_micros(F.lit(micros(now))))
        store_snapshot(path, snap, snapshot_ts, spec)
        n = seen.get.get("n", 0)
        if spec.snapshot_view and n:
            publish_view(ws.snapshots(), spec.snapshot_view)
        _end(ws, run_id, utcnow(), source_high_watermark=snapshot_ts, source_row_count=n, target_row_count=n,
             rows_quarantined=0)
        ws.set_watermark(spec.name, "gold_snapshot", "snapshot_ts", snapshot_ts, run_id, utcnow())
        return "success"

    return _guard(ws, run_id, body)


def serving_views(ws: Workspace, as_of: str) -> dict[str, DataFrame]:
    """The serving layer: scorecard and stale deals over the current fact."""
    fact = ws.gold("fact_opportunity").read()
    views = {"vw_rep_scorecard": marts.rep_scorecard(fact), "vw_stale_deals": marts.stale_deals(fact, as_of)}
    for name, df in views.items():
        publish_view(df, name)
    return views


def run_maintenance(ws: Workspace, entities=("opportunity", "quote", "contract", "phonecall", "appointment")
                    ) -> dict[str, str]:
    """Fold the silver tables of ``entities``, their facts and fact_activity into new bases clustered by key.

    Returns each table's outcome: ``folded``, ``unchanged`` (no run since the last fold), ``absent`` or the error; a failed
    table is also logged as a failed run, and the others continue.
    """
    kinds = (PHONECALL.name, APPOINTMENT.name)
    tables = [(f"silver/{e}", ws.silver(e), ENTITIES[e].primary_key) for e in entities]
    tables += [(f"gold/fact_{e}", ws.gold(f"fact_{e}"), ENTITIES[e].business_key) for e in entities if e not in kinds]
    if any(e in kinds for e in entities):
        tables.append(("gold/fact_activity", ws.gold("fact_activity"), "activity_id"))
    done = {}
    for name, table, key in tables:
        try:
            done[name] = "absent" if not table.exists() else "unchanged" if table.fold(key) is None else "folded"
        except Exception as e:  # noqa: BLE001  reported in the outcome and the run registry
            done[name] = f"{type(e).__name__}: {e}"
            now, run_id = utcnow(), f"maintenance-{name.replace('/', '-')}-{utcnow():%Y%m%d%H%M%S%f}"
            _start(ws, run_id, "crm_maintenance", name, "maintenance", now)
            _end(ws, run_id, now, status="failed", error_message=done[name])
    return done
