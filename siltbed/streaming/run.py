"""From options to a running landing: open a source by its type, choose its trigger, land it, acknowledge what has landed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from siltbed.plans import fs
from siltbed.plans.land import LandOptions
from siltbed.sources import redis
from siltbed.sources.dispatch import open_source
from siltbed.sources.kafka import KafkaSourceOptions, trigger_for
from siltbed.streaming.landing import StreamOptions, await_landing, start_landing


@dataclass
class RunOptions:
    """once: land what is there when the run begins, then end; else go on until stopped. max_batches: end after exactly so many non-empty batches (0: none).

    flush_interval_batches: land so many batches together; with flush_interval_seconds as well, whichever comes first. Seconds alone
    are the trigger's: a batch then holds what came in that time.
    """

    once: bool = False
    flush_interval_seconds: int | None = None
    flush_interval_batches: int | None = None
    max_batches: int = 0
    timeout_s: float = 3600.0


def trigger_of(kind: str, options: dict, run: RunOptions) -> dict:
    if kind == "kafka":
        return trigger_for(KafkaSourceOptions(**{**options, "once": run.once}))
    if run.once:
        return {"availableNow": True}
    if run.flush_interval_batches:
        return {"processingTime": "0 seconds"}
    return {"processingTime": f"{int(run.flush_interval_seconds or 0)} seconds"}


def start(spark: SparkSession, kind: str, options: dict, land_opts: LandOptions, sopts: StreamOptions, run: RunOptions, schema: T.StructType | None = None):
    """Start the landing of a source; returns the StreamingQuery. ``sopts.trigger`` is replaced by the one that ``run`` asks for."""
    opts = dict(options)
    if kind == "kafka":
        opts["once"] = run.once
    if kind == "redis" and run.once:
        opts["drain"] = "true"
    sopts.trigger = trigger_of(kind, options, run)
    return start_landing(open_source(spark, kind, opts), land_opts, sopts, schema=schema)


def land_source(spark: SparkSession, kind: str, options: dict, land_opts: LandOptions, sopts: StreamOptions, run: RunOptions, schema: T.StructType | None = None) -> dict:
    """Land a source to the end of the run; returns its totals. A failure of the query is raised, and nothing of the failed batch is acknowledged."""
    sopts.max_batches = run.max_batches
    if run.flush_interval_batches and kind != "kafka":  # Kafka's trigger holds a batch back until it has the rows, or the age
        sopts.flush_batches, sopts.flush_seconds = run.flush_interval_batches, run.flush_interval_seconds or 0
    q = start(spark, kind, options, land_opts, sopts, run, schema)
    got = await_landing(q, run.timeout_s if run.once else None)
    if kind == "redis" and not q.isActive and not got.get("pending"):
        end = landed_end(spark, sopts.checkpoint)
        if end is not None:
            redis.acknowledge(options, end)
    return got


def landed_end(spark: SparkSession, checkpoint: str) -> str | None:
    """The source's offset (JSON) at the end of the last micro-batch that the checkpoint knows as finished; None before the first."""
    done = [int(n) for n in fs.glob_names(spark, f"{checkpoint.rstrip('/')}/commits/*") if n.isdigit()]
    if not done:
        return None
    # a version, the batch's settings, then an offset for each source
    text = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{max(done)}", wholetext=True).first()[0]
    return text.strip().split("\n")[2]
