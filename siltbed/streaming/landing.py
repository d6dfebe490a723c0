"""Land an envelope stream: readStream -> foreachBatch(decode, quarantine, land[, compact]).

* one micro-batch = one flush, unless it is staged; its size and cadence are the trigger's and the source's.
* the micro-batch is persisted while it is read several times, then released.
* batch ids come from the checkpoint: a replayed micro-batch that is already committed is skipped. Bad rows are
  written before the commit record, replacing an earlier attempt's, so a committed batch has both.
* the JSON schema is declared, or inferred for each source by itself: a micro-batch is inferred in one pass, a schema per source, and
  what is new widens that source's schema in the registry beside the checkpoint. A key first seen late, or null until then, gets
  its column and type; another source's types don't matter. Sources of equal schema are decoded and written together; one commit covers all.
* empty micro-batches write nothing.
* with ``flush_batches``, ``flush_seconds`` or a write policy other than ``raise`` micro-batches are staged and landed several at a time
  (:mod:`siltbed.streaming.staging`). By age a flush is made with the next micro-batch, or by :func:`await_landing` while none comes.
"""

from __future__ import annotations

import json
import threading
import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import StreamingQueryException

from siltbed.functions.timeparts import with_time_partitions
from siltbed.operators.decode import check_format, check_policy, decode_arrow_ipc, decode_json, infer_json_schemas
from siltbed.operators.unions import agreed_schema
from siltbed.plans import fs
from siltbed.plans.compact import CompactOptions, compact
from siltbed.plans.land import LandOptions, batch_id_str, done_batches, land, land_quarantine
from siltbed.sources.envelope import source_id, with_source
from siltbed.streaming.progress import count_batch, counts, totals
from siltbed.streaming.staging import WRITE_POLICIES, Flushes

SIDE_CAR = "_pinned_schema"


@dataclass
class StreamOptions:
    checkpoint: str
    trigger: dict                      # e.g. {"availableNow": True} or {"processingTime": "300 seconds"}
    policy: str = "log"
    compact_every: int = 0             # compact after every k-th non-empty batch (0 = never)
    compact: CompactOptions | None = None
    time_partitions_from: str | None = None   # event-time column for date/hour partitions
    value_format: str = "json"                # or "arrow_ipc" (then the schema must be declared)
    max_batches: int = 0                      # end the run after so many non-empty batches (0: none); a next run goes on exactly there
    flush_batches: int = 0                    # land after every so many non-empty micro-batches (0: not by count)
    flush_seconds: float = 0                  # land when the oldest staged micro-batch is so old (0: not by age)
    on_write_error: str = "raise"             # a flush that can't be written: end the query, or keep it for the next flush ("log", "ignore")

    def __post_init__(self):
        check_format(self.value_format)
        check_policy(self.policy)
        if self.on_write_error not in WRITE_POLICIES:
            raise ValueError(f"unknown write policy {self.on_write_error!r}; one of {WRITE_POLICIES}")
        if self.flush_batches < 0 or self.flush_seconds < 0:
            raise ValueError("flush_batches and flush_seconds may not be negative")

    @property
    def staged(self) -> bool:
        return bool(self.flush_batches > 1 or self.flush_seconds or self.on_write_error != "raise")


SCHEMAS = "schema="
ENOUGH = "landing has reached max_batches"
UNTAGGED = ""  # the registry's key of messages without a source


def _schema_dir(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/{SIDE_CAR}"


def registry(spark: SparkSession, checkpoint: str) -> dict[str, T.StructType]:
    """The schema of each source seen so far. A registry of before sources were told apart has one schema, for all: key ``*``."""
    text = fs.newest(spark, _schema_dir(checkpoint), SCHEMAS)[1]
    kept = json.loads(text) if text else {}
    if "fields" in kept:
        kept = {"sources": {"*": kept}}
    return {k: T.StructType.fromJson(v) for k, v in kept.get("sources", {}).items()}


def pinned_schema(spark: SparkSession, checkpoint: str, source: str | None = None) -> T.StructType | None:
    """The registered schema of a source, or what all of them agree on; None before the first."""
    known = registry(spark, checkpoint)
    if source is not None:
        return known.get(source, known.get("*"))
    return agreed_schema(list(known.values())) if known else None


def pin_schemas(spark: SparkSession, checkpoint: str, schemas: dict[str, T.StructType]) -> None:
    """Keep the registry as the newest; earlier ones stay."""
    n = fs.newest(spark, _schema_dir(checkpoint), SCHEMAS)[0]
    fs.publish(spark, _schema_dir(checkpoint), SCHEMAS, n, json.dumps({"sources": {k: v.jsonValue() for k, v in sorted(schemas.items())}}))


def widened_schema(known: T.StructType | None, seen: T.StructType) -> T.StructType:
    """``known`` with the columns and types that ``seen`` adds; the order of known columns stays."""
    return agreed_schema([s for s in (known, seen) if s is not None])


def schemas_by_source(batch: DataFrame, checkpoint: str) -> list[tuple[Column, T.StructType]]:
    """(condition on the source, schema): the batch's sources by their registered schema, widened by what the batch brings; last, the
    sources that have no JSON object in this batch, and so bad rows only."""
    spark = batch.sparkSession
    known = registry(spark, checkpoint)
    seen = {source or UNTAGGED: schema for source, schema in infer_json_schemas(batch).items()}
    now = known | {source: widened_schema(known.get(source, known.get("*")), schema) for source, schema in seen.items()}
    if now != known:
        pin_schemas(spark, checkpoint, now)
    by: dict[str, list[str]] = {}
    for source, schema in now.items():
        if source != "*":
            by.setdefault(json.dumps(schema.jsonValue()), []).append(source)
    tag = F.coalesce(source_id(), F.lit(UNTAGGED))
    groups = [(tag.isin(sources), T.StructType.fromJson(json.loads(schema))) for schema, sources in by.items() if set(sources) & set(seen)]
    others = ~tag.isin(list(seen)) if seen else F.lit(True)
    return [*groups, (others, now.get("*", T.StructType([])))]


def land_envelope(batch: DataFrame, land_opts: LandOptions, sopts: StreamOptions, schema: T.StructType | None, seq: int) -> None:
    """Decode raw messages, set the bad ones aside and land the good ones as one batch."""
    tagged = with_source(batch)
    parts = [(F.lit(True), schema)] if schema is not None else schemas_by_source(batch, sopts.checkpoint)
    good, bad = [], []
    for k, (mine, use) in enumerate(parts):
        rows = tagged.where(mine)
        decoded = decode_arrow_ipc(rows, use, sopts.policy) if sopts.value_format == "arrow_ipc" else decode_json(rows, use, sopts.policy)
        bad.append(decoded.quarantine)
        if k and k == len(parts) - 1:
            continue  # bad rows only
        if sopts.time_partitions_from and sopts.time_partitions_from in decoded.good.columns:
            good.append(with_time_partitions(decoded.good, sopts.time_partitions_from))
        else:
            good.append(decoded.good)
    bad = reduce(DataFrame.unionByName, bad)
    if sopts.policy == "log" and not bad.isEmpty():
        land_quarantine(bad, land_opts, batch_seq=seq)
    land(good, land_opts, batch_seq=seq)


def make_batch_writer(land_opts: LandOptions, sopts: StreamOptions, schema: T.StructType | None):
    if sopts.value_format == "arrow_ipc" and schema is None:
        raise ValueError("arrow_ipc payloads need a declared schema")
    state = {"n": 0, "before": None, "raw": None}
    lock = threading.Lock()  # the query's thread and await_landing's

    def is_done(spark: SparkSession, seq: int) -> bool:
        bid = batch_id_str(land_opts, seq)
        return bid in done_batches(spark, land_opts, [bid])

    def landed(spark: SparkSession) -> None:
        state["n"] += 1
        if sopts.compact_every and state["n"] % sopts.compact_every == 0:
            compact(spark, land_opts.base, sopts.compact or CompactOptions())

    def land_flush(rows: DataFrame, seq: int) -> None:
        rows = rows.persist()
        try:
            land_envelope(rows, land_opts, sopts, schema, seq)
        finally:
            rows.unpersist()
        landed(rows.sparkSession)

    flushes = Flushes(sopts.checkpoint, land_flush, is_done, sopts.flush_batches or int(not sopts.flush_seconds), sopts.flush_seconds, sopts.on_write_error)

    def write(batch: DataFrame, epoch_id: int) -> None:
        with lock:
            take(batch, epoch_id)

    def take(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        state["raw"] = batch.schema
        known = counts(spark, sopts.checkpoint)
        if state["before"] is None:
            state["before"] = known["batches"]
            if not sopts.staged and (flushes.waiting(spark) or flushes.pending(spark)):  # left by a run that staged
                flushes.flush(spark, batch.schema)
        kept = flushes.holds(spark, epoch_id)
        if kept or is_done(spark, epoch_id):  # a replay of a batch that is durable
            if epoch_id > known["last"]:  # and died before it was counted
                count_batch(spark, sopts.checkpoint, epoch_id, batch.count())
            if kept:
                flushes.flush_if_due(spark, batch.schema)
            return
        batch = batch.persist()
        try:
            n_rows = batch.count()
            if not n_rows:
                return
            if sopts.max_batches and known["batches"] - state["before"] >= sopts.max_batches:
                raise RuntimeError(ENOUGH)  # this batch is planned, not landed: the next run begins with it
            if sopts.staged:
                flushes.stage(batch, epoch_id)
            else:
                land_envelope(batch, land_opts, sopts, schema, epoch_id)
            count_batch(spark, sopts.checkpoint, epoch_id, n_rows)
            if not sopts.staged:
                landed(spark)
        finally:
            batch.unpersist()
        if sopts.staged:
            flushes.flush_if_due(spark, batch.schema)

    def tick(spark: SparkSession, raw: T.StructType, last: bool = False) -> list[tuple[int, int]]:
        """Flush if one is due, or whatever is staged at the ``last`` call; returns the flushes that are still to be landed."""
        with lock:
            if last:
                flushes.flush(spark, state["raw"] or raw)
            else:
                flushes.flush_if_due(spark, state["raw"] or raw)
            return flushes.pending(spark)

    write.tick = tick
    return write


def start_landing(stream: DataFrame, land_opts: LandOptions, sopts: StreamOptions,
                  schema: T.StructType | None = None, query_name: str | None = None):
    """Start the landing query; returns the StreamingQuery."""
    writer = make_batch_writer(land_opts, sopts, schema)
    w = (stream.writeStream.foreachBatch(writer)
         .option("checkpointLocation", sopts.checkpoint).trigger(**sopts.trigger))
    if query_name:
        w = w.queryName(query_name)
    spark = stream.sparkSession
    before = counts(spark, sopts.checkpoint)
    query = w.start()

    def since_start() -> dict:
        now = counts(spark, sopts.checkpoint)
        return {k: now[k] - before[k] for k in ("batches", "rows")}

    query.siltbed_totals = since_start
    if sopts.staged:
        query.siltbed_tick = lambda last=False: writer.tick(spark, stream.schema, last)
    return query


def await_landing(query, timeout_s: float | None = None, poll_s: float = 1.0) -> dict:
    """Wait for a landing's end and return its totals; reaching ``max_batches`` is an end, any other failure is raised.

    A landing that stages is flushed by age while it waits, and once more when the query has ended without a failure. ``pending`` of its
    totals counts the flushes that could not be written; the next run tries them again.
    """
    tick = getattr(query, "siltbed_tick", None)
    ended = False
    try:
        if tick is None:
            query.awaitTermination(timeout_s)
        else:
            deadline = None if timeout_s is None else time.monotonic() + timeout_s
            while not ended and (deadline is None or time.monotonic() < deadline):
                ended = query.awaitTermination(poll_s)
                if not ended:
                    tick()
    except StreamingQueryException as e:
        if ENOUGH not in str(e):
            raise
        ended = True
    if tick is None:
        return totals(query)
    return {**totals(query), "pending": len(tick(last=True) if ended else tick())}


def stop_after_batches(query, max_batches: int, timeout_s: float = 3600.0, poll_s: float = 0.5) -> int:
    """Stop a running query once ``max_batches`` non-empty micro-batches have finished (0 = run on).

    It looks from outside, so a batch more may have been landed; ``StreamOptions.max_batches`` is exact. Safe to stop early: a batch whose offsets were planned but not committed is replayed on
    restart, and its landing is idempotent. Returns the number of non-empty batches seen.
    """
    if not max_batches:
        query.awaitTermination(timeout_s)
        return totals(query)["batches"]
    deadline = time.monotonic() + timeout_s
    while query.isActive and time.monotonic() < deadline:
        if totals(query)["batches"] >= max_batches:
            query.stop()
            break
        time.sleep(poll_s)
    return totals(query)["batches"]
