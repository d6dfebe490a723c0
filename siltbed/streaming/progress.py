"""Streaming metrics: durable counters beside the checkpoint, and totals from a query's progress."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from siltbed.plans import fs

COUNTS = "batch="


def _counts_dir(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/_counts"


def counts(spark: SparkSession, checkpoint: str) -> dict:
    """Non-empty batches and their input rows since the checkpoint began; ``last`` is the number of the last one (-1: none)."""
    n, text = fs.newest(spark, _counts_dir(checkpoint), COUNTS)
    return {**json.loads(text), "last": n} if text else {"batches": 0, "rows": 0, "last": -1}


def count_batch(spark: SparkSession, checkpoint: str, number: int, rows: int) -> None:
    """Count a finished batch, once however often it is replayed: a small file per batch holds the totals up to it, the last two are kept."""
    now = counts(spark, checkpoint)
    if number <= now["last"]:
        return
    folder = _counts_dir(checkpoint)
    for n in fs.glob_names(spark, f"{folder}/{COUNTS}*"):  # a file that a dead writer left unfinished would be in the way
        if int(n[len(COUNTS):]) != now["last"]:
            fs.delete(spark, f"{folder}/{n}")
    fs.create_text(spark, f"{folder}/{COUNTS}{number:012d}", json.dumps({"batches": now["batches"] + 1, "rows": now["rows"] + rows}))


class ProgressTotals(StreamingQueryListener):
    """Totals of batches and input rows per query (A1/A2 for streams)."""

    def __init__(self):
        self.batches: dict[str, int] = {}
        self.rows: dict[str, int] = {}

    def onQueryStarted(self, event):  # noqa: N802 - listener API
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        name = p.name or str(p.id)
        if p.numInputRows:
            self.batches[name] = self.batches.get(name, 0) + 1
            self.rows[name] = self.rows.get(name, 0) + int(p.numInputRows)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass


def totals(query) -> dict:
    """Non-empty batches and input rows of a query since it was started.

    A landing has durable counters; of any other query only the last hundred progress reports are known.
    """
    if hasattr(query, "siltbed_totals"):
        return query.siltbed_totals()
    ps = [p for p in query.recentProgress if p.get("numInputRows", 0)]
    return {"batches": len(ps), "rows": sum(int(p["numInputRows"]) for p in ps)}
