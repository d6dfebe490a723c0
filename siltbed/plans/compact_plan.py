"""Compaction planning over a file listing (pure DataFrame functions).

A listing has at least ``dir`` (leaf folder) and ``name``; ``length`` when known.
Candidates are flush files (``data_*.parquet``); ``merged_*`` and other names are left
alone. Names that look like flush files but carry no valid timestamp are reported as
malformed, never silently dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.functions.periods import PERIODS, period_key_from_name


def candidates(listing: DataFrame, name: str = "name") -> DataFrame:
    n = F.col(name)
    return listing.where(n.startswith("data_") & n.endswith(".parquet"))


def with_period(listing: DataFrame, period: str = "hour", week_year: str = "iso", name: str = "name") -> DataFrame:
    """Add ``period_key``; any period name other than hour/day/week/month means day."""
    p = period if period in PERIODS else "day"
    return listing.withColumn("period_key", period_key_from_name(F.col(name), p, week_year))


def name_status(listing: DataFrame, name: str = "name") -> DataFrame:
    """Per folder: flush files with a usable timestamp vs names left alone."""
    k = period_key_from_name(F.col(name), "day")
    return (listing.groupBy("dir")
            .agg(F.count(F.when(k.isNotNull(), 1)).alias("n_ok"), F.count(F.when(k.isNull(), 1)).alias("n_malformed")))


def merge_plan(listing: DataFrame, period: str = "hour", min_files: int = 2, week_year: str = "iso") -> DataFrame:
    """Groups (dir, period_key) with at least ``min_files`` flush files."""
    keyed = with_period(candidates(listing), period, week_year).where(F.col("period_key").isNotNull())
    aggs = [F.count(F.lit(1)).alias("n_files")]
    if "length" in listing.columns:
        aggs.append(F.sum("length").cast("long").alias("bytes"))
    return keyed.groupBy("dir", "period_key").agg(*aggs).where(F.col("n_files") >= F.lit(int(min_files)))
