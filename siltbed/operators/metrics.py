"""Accounting: records and batches per source and sink, errors per reason.

Counts are DataFrame aggregations (exact, partially aggregated) or ``Observation``s that
ride along a write without a second pass. Each bad row is counted once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from siltbed.sources.envelope import SOURCE_COL


def metrics_by_source(ordered_batches: DataFrame, kinds: DataFrame, sink_kind: str) -> DataFrame:
    """records / batches per (source kind, sink kind, source); ``kinds`` maps source -> kind."""
    per_src = (ordered_batches.groupBy(SOURCE_COL)
               .agg(F.count(F.lit(1)).alias("n_batches"), F.sum("n_rows").cast("long").alias("n_records")))
    # kinds is one row per source (bounded by the number of sources)
    k = kinds.select(F.col(SOURCE_COL).alias("_k_src"), F.col("kind").alias("_k_kind"))
    return (per_src.join(k, on=per_src[SOURCE_COL].eqNullSafe(k["_k_src"]), how="left")
            .select(F.col("_k_kind").alias("kind"), F.lit(sink_kind).alias("sink"), SOURCE_COL,
                    "n_batches", "n_records"))


def errors_by_reason(quarantine: DataFrame) -> DataFrame:
    return (quarantine.groupBy(SOURCE_COL, "reason")
            .agg(F.count(F.lit(1)).alias("n_errors")))


def observe_counts(df: DataFrame, name: str = "landed") -> tuple[DataFrame, Observation]:
    """Attach row/source counters to a DataFrame; read ``obs.get`` after the action."""
    obs = Observation(name)
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                     F.approx_count_distinct(SOURCE_COL).alias("sources") if SOURCE_COL in df.columns
                     else F.lit(0).alias("sources"))
    return out, obs
