"""Derive time partition columns from an event-time column (session zone UTC)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_time_partitions(df: DataFrame, ts: str, date_col: str = "date", hour_col: str | None = "hour") -> DataFrame:
    """``date`` as ``yyyy-MM-dd`` string and ``hour`` as int, from ``ts``."""
    out = df.withColumn(date_col, F.date_format(F.col(ts), "yyyy-MM-dd"))
    if hour_col:
        out = out.withColumn(hour_col, F.hour(F.col(ts)).cast("int"))
    return out
