"""Serving views."""

from __future__ import annotations

from pyspark.sql import DataFrame


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW name AS SELECT * FROM fact`` as a temp view."""
    df.createOrReplaceTempView(name)
    return df
