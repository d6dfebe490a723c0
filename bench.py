"""Benchmark the headline jobs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries": {name: sec}, "sf", ...}.
Stages: land (batch), read-back counts before compaction, backfill landing as many small
flushes, compaction, read-back after, streaming drain (availableNow), batch planning,
decode with quarantine, Arrow IPC decode.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    from pyspark.sql import functions as F

    from siltbed.session import build_session
    from siltbed.plans import catalog  # noqa: F401
    from siltbed.plans import catalog_land as CL
    from siltbed.plans import fixtures as fx
    from siltbed.plans.compact import CompactOptions, compact
    from siltbed.plans.land import LandOptions, land
    from siltbed.plans.read import dataset_state, read_dataset
    from siltbed.plans.registry import QUERIES
    from siltbed.functions.timeparts import with_time_partitions
    from siltbed.session import scratch_path

    spark = build_session(app="siltbed-bench")
    times: dict[str, float] = {}
    extra: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()

    # warm-up (JVM, Python workers) outside the timings
    drain(QUERIES["source_tag"](spark, sf_dir))

    # 1. land: envelope -> decode -> (source, date) partitions, one batch
    opts = LandOptions(base=scratch_path(spark, "bench_land"), partition_by=["date"])
    good = with_time_partitions(CL._decoded(spark, sf_dir), "ts")
    timed("land_batch", lambda: land(good, opts, batch_seq=1))
    extra["land_rows_per_sec"] = round(n_events / max(times["land_batch"], 1e-9), 1)

    since = lambda base: (read_dataset(spark, base).where(F.col("date") >= F.lit(CL.SINCE))
                          .groupBy("_source_id").count().collect())
    timed("event_counts_since", lambda: since(opts.base))

    # 2. backfill as many small flushes (6-hour blocks), then compact by day
    opts2 = LandOptions(base=scratch_path(spark, "bench_small"), partition_by=["date"])
    blocks = good.withColumn("_blk", CL._block())
    plan = CL.block_plan(fx.events_envelope(spark, sf_dir))  # from the envelope: no second decode
    timed("land_small_flushes", lambda: land(blocks, opts2, batch_col="_blk", batches=plan))
    files_before = dataset_state(spark, opts2.base).live_land.count()
    timed("counts_before_compaction", lambda: since(opts2.base))
    report = timed("compact_day", lambda: compact(spark, opts2.base, CompactOptions(period="day", min_files=2))
                   .where("status = 'merged'").agg(F.sum("bytes")).first()[0])
    extra["compaction_mb_per_sec"] = round((report or 0) / 1e6 / max(times["compact_day"], 1e-9), 3)
    st = dataset_state(spark, opts2.base)
    files_after = st.live_land.count() + st.live_compacted.count()
    timed("counts_after_compaction", lambda: since(opts2.base))
    extra.update(files_before=files_before, files_after=files_after)

    # 3. streaming landing, availableNow over envelope files
    timed("stream_drain", lambda: CL._stream_land(spark, sf_dir, "bench_stream"))

    # 4. planning and decode paths
    for q in ("batch_order", "flush_plan_batches", "json_decode_inferred", "quarantine_poison", "arrow_ipc_decode",
              "merge_plan"):
        timed(q, lambda q=q: drain(QUERIES[q](spark, sf_dir)))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf,
                      "events": n_events, **extra}))
    spark.stop()


if __name__ == "__main__":
    main()
