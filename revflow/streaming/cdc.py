"""Continuous change data capture into the silver current state (T5).

Each micro-batch is checked, its bad rows are quarantined, and the rest is deduplicated and appended to the state's change log as one
run, named by the stream's id and the batch id. A micro-batch that is replayed after a failure between the write and the checkpoint's
commit replaces its own rows, while a new stream's batches are runs of their own. The write is proportional to the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revflow.operators import control
from revflow.plans.medallion import silver_source
from revflow.sources.deltas import ChangeTable
from revflow.spec import EntitySpec


def micros(t: datetime) -> int:
    """Microseconds since 1970 (UTC); a time without a zone is UTC."""
    t = t if t.tzinfo else t.replace(tzinfo=timezone.utc)
    return round((t - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds() * 1e6)


def stream_id(spark: SparkSession) -> str:
    """The id of the streaming query that runs this micro-batch (kept in its checkpoint); empty outside a stream."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The bad rows of every micro-batch so far."""
    return spark.read.schema(control.BAD_RECORDS_SCHEMA).parquet(f"{path}/query_id=*/batch_id=*")


class CurrentStateWriter:
    """``foreachBatch`` callback: bronze micro-batch -> bad rows to ``quarantine``, the others to the change log of ``state``.

    A batch's bad rows are written to its own folder under ``quarantine`` (overwritten when the batch is replayed), so none
    is lost or doubled.
    """

    def __init__(self, state: ChangeTable, spec: EntitySpec, run_id_of: Callable[[int], str], quarantine: str,
                 run_ts: Column | None = None, tie_breakers: Sequence[str] = ()):
        self.state, self.spec = state, spec
        self.run_id_of, self.run_ts = run_id_of, run_ts
        self.tie_breakers = tuple(tie_breakers)
        self.quarantine = quarantine.rstrip("/")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        query_id = stream_id(batch.sparkSession) or "none"
        now = micros(datetime.now(timezone.utc))
        run_ts = self.run_ts if self.run_ts is not None else F.timestamp_micros(F.lit(now))
        source, bad = silver_source(batch, self.spec, self.run_id_of(batch_id), run_ts, self.tie_breakers)
        if self.spec.quarantine_enabled:
            bad.write.mode("overwrite").parquet(f"{self.quarantine}/query_id={query_id}/batch_id={batch_id}")
        self.state.append(source, f"{query_id}-{batch_id:012d}", now, replays=True)


def start_current_state_stream(bronze: DataFrame, writer: CurrentStateWriter, checkpoint: str,
                               trigger: dict | None = None):
    """T5: run the writer over every micro-batch of a bronze stream."""
    return (bronze.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
