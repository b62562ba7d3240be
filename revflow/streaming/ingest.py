"""Bronze ingest as a Structured Streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from revflow.functions.cdc import classify_changes, stamp_lineage
from revflow.sources.files import check_format
from revflow.sources.schemas import GENERATION
from revflow.spec import DEFAULT_MICROBATCH_INTERVAL, EntitySpec


#: Trigger argument of each mode, and the value it takes from the configured interval.
TRIGGERS = {
    "available_now": ("availableNow", lambda interval: True),
    "micro_batch": ("processingTime", lambda interval: interval or DEFAULT_MICROBATCH_INTERVAL),
}


def trigger_kwargs(mode: str, interval: str | None = None) -> dict:
    """Arguments of ``writeStream.trigger``. Continuous processing is not among
    the modes: Spark's file source can't run it."""
    if mode not in TRIGGERS:
        raise ValueError(f"trigger mode {mode!r} can't run a file stream; choose one of {', '.join(TRIGGERS)}")
    name, value = TRIGGERS[mode]
    return {name: value(interval)}


def read_feed_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """Each new file of ``path`` is read once. The schema is required
    (use ``files.infer_feed_schema`` on the landed files)."""
    r = spark.readStream.format(check_format(fmt)).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    if fmt == "csv":
        r = r.option("header", "true")
    return r.load(path)


def bronze_stream(raw: DataFrame, spec: EntitySpec, run_id: str, ingest_ts=None) -> DataFrame:
    """P1 + P2 on the stream; the source file comes from the file metadata column,
    and ``ingestion_date`` is added for partitioning (X28)."""
    df = stamp_lineage(classify_changes(raw, spec), spec, run_id, ingest_ts, F.col("_metadata.file_path"))
    if "_metadata" in df.columns:  # carried by a feed that was parsed from lines
        df = df.drop("_metadata")
    return df.withColumn("ingestion_date", F.to_date("bronze_ingest_ts"))


def start_bronze_sink(bronze: DataFrame, table_path: str, checkpoint: str, trigger_mode: str = "available_now",
                      interval: str | None = None, query_name: str | None = None) -> StreamingQuery:
    """Append to a parquet table partitioned by ingestion date (and the schema's generation, where a store gives it).

    The checkpoint makes the file sink exactly-once: a restarted query with the
    same checkpoint skips files it already committed.
    """
    parts = [c for c in (GENERATION, "ingestion_date") if c in bronze.columns]
    w = (bronze.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .option("path", table_path).partitionBy(*parts).outputMode("append")
         .trigger(**trigger_kwargs(trigger_mode, interval)))
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def run_bronze_available_now(bronze: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """One ``availableNow`` pass: ingest everything new, then stop."""
    q = start_bronze_sink(bronze, table_path, checkpoint, "available_now")
    q.awaitTermination()
    return q
