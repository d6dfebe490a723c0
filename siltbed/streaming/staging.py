"""Flushes of several micro-batches: stage raw messages beside the checkpoint, seal, land, clear.

A micro-batch is staged as Parquet of its raw messages, whatever the source, and is durable from then on. A flush is sealed when
enough micro-batches are staged or the oldest is old enough: a name ``flush=<first>-<last>`` fixes which ones it takes. It is landed under
the number of its last micro-batch, decoded only then. A crash at any step repeats the step: a sealed flush always takes the same rows under the same
batch id, which :func:`siltbed.plans.land.land` commits once. A flush that fails stays sealed and is tried again with the next one.

    checkpoint/_staged/epoch=<n>/part-*.parquet      raw messages
    checkpoint/_staged/ready=<n>-<millis>            the micro-batch is whole, and when it was staged
    checkpoint/_flushes/flush=<first>-<last>         a sealed flush; the newest is kept when it is done
    checkpoint/_flushes/done=<last>                  it has been landed (one with bad rows only has no commit record)
    checkpoint/_flush_errors/<last>-<millis>         a failed attempt (JSON)
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.plans import fs

log = logging.getLogger(__name__)

WRITE_POLICIES = ("raise", "log", "ignore")
ERRORS = "batch string, attempt_at timestamp, error_type string, message string"


def _pairs(names: set[str], prefix: str) -> list[tuple[int, int]]:
    """The two numbers of each name ``<prefix><a>-<b>``, in order."""
    found = (n[len(prefix):].partition("-") for n in names if n.startswith(prefix))
    return sorted((int(a), int(b)) for a, _, b in found if a.isdigit() and b.isdigit())


class Flushes:
    """The staged micro-batches of a checkpoint, and their flushes.

    ``land(rows, number)`` writes one flush, ``done(number)`` tells whether it is committed. ``batches`` and ``seconds`` say when a flush is
    due (0: not by that); with neither only :meth:`finish` flushes. ``on_error``: ``raise``, or keep the flush and go on, with a record (``log``) or
    without (``ignore``).
    """

    def __init__(self, checkpoint: str, land: Callable[[DataFrame, int], None], done: Callable[[SparkSession, int], bool],
                 batches: int = 0, seconds: float = 0, on_error: str = "raise"):
        if on_error not in WRITE_POLICIES:
            raise ValueError(f"unknown write policy {on_error!r}; one of {WRITE_POLICIES}")
        root = checkpoint.rstrip("/")
        self.staged_dir, self.seals_dir, self.errors_dir = f"{root}/_staged", f"{root}/_flushes", f"{root}/_flush_errors"
        self.land, self.done = land, done
        self.batches, self.seconds, self.on_error = batches, seconds, on_error

    def seals(self, spark: SparkSession) -> list[tuple[int, int]]:
        """(first, last) of the sealed flushes that are still known: those to be landed, and the newest."""
        return _pairs(fs.glob_names(spark, f"{self.seals_dir}/flush=*"), "flush=")

    def waiting(self, spark: SparkSession) -> list[tuple[int, int]]:
        """(micro-batch, milliseconds) of the staged ones that no flush has taken."""
        sealed = max((last for _, last in self.seals(spark)), default=-1)
        return [x for x in _pairs(fs.glob_names(spark, f"{self.staged_dir}/ready=*"), "ready=") if x[0] > sealed]

    def pending(self, spark: SparkSession) -> list[tuple[int, int]]:
        """Sealed flushes that have not been landed."""
        marked = fs.glob_names(spark, f"{self.seals_dir}/done=*")
        return [s for s in self.seals(spark) if f"done={s[1]:012d}" not in marked and not self.done(spark, s[1])]

    def holds(self, spark: SparkSession, number: int) -> bool:
        """Whether a micro-batch is staged or has been: its replay brings nothing new."""
        return any(number <= last for _, last in self.seals(spark)) or any(n == number for n, _ in self.waiting(spark))

    def stage(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if self.holds(spark, number):
            return
        batch.write.mode("overwrite").parquet(f"{self.staged_dir}/epoch={number:012d}")
        fs.create_text(spark, f"{self.staged_dir}/ready={number:012d}-{int(time.time() * 1000)}", "")

    def due(self, spark: SparkSession) -> bool:
        found = self.waiting(spark)
        if not found:
            return False
        by_age = self.seconds and time.time() * 1000 - min(at for _, at in found) >= 1000 * self.seconds
        return bool(by_age or (self.batches and len(found) >= self.batches))

    def flush_if_due(self, spark: SparkSession, schema: T.StructType) -> int:
        """Seal and land if a flush is due; returns how many flushes were landed, earlier failed ones included."""
        return self.flush(spark, schema) if self.due(spark) else 0

    def flush(self, spark: SparkSession, schema: T.StructType) -> int:
        """Seal what is staged, then land every sealed flush that isn't committed, the oldest first."""
        found = [n for n, _ in self.waiting(spark)]
        if found:
            fs.create_text(spark, f"{self.seals_dir}/flush={found[0]:012d}-{found[-1]:012d}", "")
        landed = 0
        for first, last in self.pending(spark):
            staged = {n for n, _ in _pairs(fs.glob_names(spark, f"{self.staged_dir}/ready=*"), "ready=") if first <= n <= last}
            rows = spark.read.schema(schema).parquet(*[f"{self.staged_dir}/epoch={n:012d}" for n in sorted(staged)])
            try:
                self.land(rows, last)
                fs.create_text(spark, f"{self.seals_dir}/done={last:012d}", "")
                landed += 1
            except Exception as e:  # noqa: BLE001 - the policy decides
                if self.on_error == "raise":
                    raise
                if self.on_error == "log":
                    self._record(spark, last, e)
        self.clear(spark)
        return landed

    def clear(self, spark: SparkSession) -> None:
        """Remove what committed flushes have taken, and their seals but for the newest."""
        seals, open_ = self.seals(spark), set(self.pending(spark))
        newest = seals[-1][1] if seals else -1
        for n, at in _pairs(fs.glob_names(spark, f"{self.staged_dir}/ready=*"), "ready="):
            if n <= newest and not any(a <= n <= b for a, b in open_):
                fs.delete(spark, f"{self.staged_dir}/epoch={n:012d}")
                fs.delete(spark, f"{self.staged_dir}/ready={n:012d}-{at}")
        for first, last in seals[:-1]:
            if (first, last) not in open_:
                fs.delete(spark, f"{self.seals_dir}/flush={first:012d}-{last:012d}")
                fs.delete(spark, f"{self.seals_dir}/done={last:012d}")

    def _record(self, spark: SparkSession, number: int, e: Exception) -> None:
        log.error("flush %d was not written and is kept: %s", number, e)
        at = int(time.time() * 1000)
        text = json.dumps({"batch": number, "at": at, "type": type(e).__name__, "message": str(e)[:2000]})
        fs.create_text(spark, f"{self.errors_dir}/{number:012d}-{at}", text)


def flush_errors(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Failed attempts to write flushes, one row each: batch number, time, exception and message."""
    folder = f"{checkpoint.rstrip('/')}/_flush_errors"
    if not fs.exists(spark, folder):
        return spark.createDataFrame([], ERRORS)
    rows = spark.read.schema("batch long, at long, type string, message string").json(folder)
    return rows.select(F.col("batch").cast("string").alias("batch"), F.timestamp_millis("at").alias("attempt_at"), F.col("type").alias("error_type"), "message")
