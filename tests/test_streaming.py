"""Streaming landing: schema pinned once, empty micro-batches write nothing, formats checked."""

import pytest
from pyspark.sql import functions as F

from siltbed.plans import fixtures as fx
from siltbed.plans.land import LandOptions
from siltbed.plans.read import dataset_state, read_dataset
from siltbed.session import scratch_path
from siltbed.sources.envelope import ENVELOPE
from siltbed.streaming.landing import StreamOptions, pinned_schema, start_landing
from siltbed.streaming.progress import totals


def _run(spark, src, opts, sopts, schema=None):
    q = start_landing(spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 2).parquet(src), opts, sopts,
                      schema=schema)
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_inferred_schema_is_pinned_and_rows_land(spark, sf_dir):
    src = scratch_path(spark, "s_src")
    fx.events_envelope(spark, sf_dir).repartitionByRange(4, "offset").write.parquet(src)
    opts = LandOptions(base=scratch_path(spark, "s_lake"), query="s1")
    sopts = StreamOptions(checkpoint=scratch_path(spark, "s_ckpt"), trigger={"availableNow": True})
    q = _run(spark, src, opts, sopts)
    pinned = pinned_schema(spark, sopts.checkpoint)
    assert [f.name for f in pinned.fields] == ["event_id", "props", "ts", "user_id", "value"]
    n = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert read_dataset(spark, opts.base).count() == n
    t = totals(q)
    assert t["rows"] == n and t["batches"] == 2
    # restart on the same checkpoint with nothing new: no batch, nothing written twice
    commits_before = dataset_state(spark, opts.base).commits.count()
    _run(spark, src, opts, sopts)
    assert dataset_state(spark, opts.base).commits.count() == commits_before
    assert read_dataset(spark, opts.base).count() == n


def test_empty_source_writes_nothing(spark, sf_dir):
    src = scratch_path(spark, "s_empty")
    fx.events_envelope(spark, sf_dir).where(F.lit(False)).write.parquet(src)
    opts = LandOptions(base=scratch_path(spark, "s_lake_empty"), query="s2")
    sopts = StreamOptions(checkpoint=scratch_path(spark, "s_ckpt_empty"), trigger={"availableNow": True})
    _run(spark, src, opts, sopts)
    assert dataset_state(spark, opts.base).commits.count() == 0


def test_stream_options_refuse_unknown_format_and_policy():
    with pytest.raises(ValueError):
        StreamOptions(checkpoint="/x", trigger={"availableNow": True}, value_format="avro")
    with pytest.raises(ValueError):
        StreamOptions(checkpoint="/x", trigger={"availableNow": True}, policy="maybe")


def test_stop_after_max_batches_then_resume_lands_everything_once(spark, sf_dir):
    from siltbed.streaming.landing import stop_after_batches

    src = scratch_path(spark, "s_max_src")
    fx.events_envelope(spark, sf_dir).repartitionByRange(6, "offset").write.parquet(src)
    opts = LandOptions(base=scratch_path(spark, "s_max_lake"), query="s3")
    sopts = StreamOptions(checkpoint=scratch_path(spark, "s_max_ckpt"), trigger={"processingTime": "1 second"})
    stream = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(src)
    from siltbed.plans.catalog_decode import EVENT_SCHEMA

    q = start_landing(stream, opts, sopts, schema=EVENT_SCHEMA)
    seen = stop_after_batches(q, 2, timeout_s=300)
    assert seen >= 2
    landed = read_dataset(spark, opts.base).count()
    n = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert 0 < landed < n
    # resume from the checkpoint and drain: every row exactly once
    sopts.trigger = {"availableNow": True}
    q2 = start_landing(spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(src), opts, sopts,
                       schema=EVENT_SCHEMA)
    q2.awaitTermination()
    assert read_dataset(spark, opts.base).count() == n
