"""Small change-log builders shared by the tests."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from revflow.spec import EntitySpec

SPEC = EntitySpec(name="t", primary_key="k", mandatory_columns=("k",), non_negative_columns=("v",))
LOG_SCHEMA = "k long, seq long, v double, change_operation string, modifiedon timestamp, batch long"
T0 = datetime(2024, 1, 1)


def log_df(spark, rows):
    """rows: (key, seq, value, op, batch); event time = T0 + seq minutes."""
    data = [(k, s, v, op, T0 + timedelta(minutes=s), b) for k, s, v, op, b in rows]
    df = spark.createDataFrame(data, LOG_SCHEMA)
    return df.withColumns({
        "bronze_op_type": F.when(F.col("change_operation") == "D", "DELETE").otherwise("UPSERT"),
        "bronze_is_delete": F.col("change_operation") == "D",
        "bronze_ingest_ts": (F.lit(T0) + F.make_dt_interval(days=F.col("batch"))).cast("timestamp"),
        "bronze_business_event_ts": F.col("modifiedon"),
        "run_id": F.concat(F.lit("run-"), F.col("batch").cast("string")),
    })


def run_ts_of(b):
    return (T0 + timedelta(days=b)).strftime("%Y-%m-%d %H:%M:%S")
