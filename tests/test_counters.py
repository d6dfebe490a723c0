"""Counters of a landing are durable, count a replayed batch once, and end a run exactly."""

from siltbed.plans import fixtures as fx
from siltbed.plans import fs
from siltbed.plans.catalog_decode import EVENT_SCHEMA
from siltbed.plans.land import LandOptions
from siltbed.plans.read import dataset_state, read_dataset
from siltbed.session import scratch_path
from siltbed.streaming import progress as P
from siltbed.streaming.landing import StreamOptions
from siltbed.streaming.run import RunOptions, land_source
from test_regressions import envelope, writer


def test_more_batches_than_a_querys_progress_remembers(spark):
    ckpt = scratch_path(spark, "counts")
    for n in range(150):
        P.count_batch(spark, ckpt, n, 10)
        if n % 7 == 0:
            P.count_batch(spark, ckpt, n, 10)  # a replay
    assert P.counts(spark, ckpt) == {"batches": 150, "rows": 1500, "last": 149}
    assert len(fs.glob_names(spark, f"{ckpt}/_counts/*")) <= 2
    f, p = fs._fs(spark, f"{ckpt}/_counts/{P.COUNTS}{150:012d}")
    f.create(p, False).close()  # a writer that died half-way
    assert P.counts(spark, ckpt)["batches"] == 150
    P.count_batch(spark, ckpt, 150, 1)
    assert P.counts(spark, ckpt) == {"batches": 151, "rows": 1501, "last": 150}


def test_a_batch_that_died_between_commit_and_counter_is_counted_by_its_replay(spark, monkeypatch):
    from siltbed.streaming import landing

    opts, sopts, write = writer(spark, "counts_replay")
    batch = envelope(spark, [("a", 0, i, i, '{"x": 1}' if i else "bad") for i in range(4)])
    real = landing.count_batch
    monkeypatch.setattr(landing, "count_batch", lambda *a: (_ for _ in ()).throw(OSError("died")))
    try:
        write(batch, 0)
    except OSError:
        pass
    assert P.counts(spark, sopts.checkpoint)["batches"] == 0
    monkeypatch.setattr(landing, "count_batch", real)
    write(batch, 0)
    write(batch, 0)
    assert P.counts(spark, sopts.checkpoint) == {"batches": 1, "rows": 4, "last": 0} and read_dataset(spark, opts.base).count() == 3


def test_max_batches_is_exact_and_the_next_run_goes_on(spark, sf_dir):
    src = scratch_path(spark, "counts_src")
    fx.events_envelope(spark, sf_dir).repartitionByRange(5, "offset").write.parquet(src)
    opts = LandOptions(base=scratch_path(spark, "counts_lake"), query="counts")
    sopts = StreamOptions(checkpoint=scratch_path(spark, "counts_ckpt"), trigger={})
    n = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seen = []
    for most in (2, 2, 0):
        got = land_source(spark, "files", {"path": src, "maxFilesPerTrigger": "1"}, opts, sopts, RunOptions(once=True, max_batches=most), EVENT_SCHEMA)
        seen.append((got["batches"], dataset_state(spark, opts.base).commits.select("_batch_id").distinct().count()))
    assert seen == [(2, 2), (2, 4), (1, 5)]
    assert read_dataset(spark, opts.base).count() == n and P.counts(spark, sopts.checkpoint)["rows"] == n
