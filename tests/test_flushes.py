"""Flushes of several micro-batches by count and age, and what happens to a flush that can't be written."""

import time

import pytest

from siltbed.plans import fixtures as fx
from siltbed.plans import fs
from siltbed.plans.catalog_decode import EVENT_SCHEMA
from siltbed.plans.land import LandOptions
from siltbed.plans.read import dataset_state, read_dataset
from siltbed.session import scratch_path
from siltbed.sources.envelope import ENVELOPE
from siltbed.streaming import landing, staging
from siltbed.streaming.landing import StreamOptions, make_batch_writer
from siltbed.streaming.run import RunOptions, land_source, trigger_of
from test_redis_drain import N, SCHEMA, landed, store  # noqa: F401  (a fixture)
from test_regressions import envelope


def place(spark, name, **kw):
    return LandOptions(base=scratch_path(spark, name), query=name), StreamOptions(checkpoint=scratch_path(spark, name, "ckpt"), trigger={}, **kw)


def rows(spark, n, first=0, value='{"x": 1}'):
    return envelope(spark, [("a", 0, first + i, i, value) for i in range(n)])


def commits(spark, opts):
    return sorted(r[0] for r in dataset_state(spark, opts.base).commits.select("_batch_id").distinct().collect())


@pytest.fixture(scope="module")
def five_files(spark, sf_dir):
    src = scratch_path(spark, "flush_src")
    fx.events_envelope(spark, sf_dir).repartitionByRange(5, "offset").write.parquet(src)
    return {"path": src, "maxFilesPerTrigger": "1"}, spark.read.parquet(f"{sf_dir}/events.parquet").count()


@pytest.mark.parametrize("seconds", [None, 3600])
def test_five_batches_every_two_are_three_flushes(spark, five_files, seconds):
    options, n = five_files
    opts, sopts = place(spark, f"flush_two{seconds or ''}")
    run = RunOptions(once=True, flush_interval_batches=2, flush_interval_seconds=seconds)
    got = land_source(spark, "files", options, opts, sopts, run, EVENT_SCHEMA)
    assert got == {"batches": 5, "rows": n, "pending": 0}
    assert commits(spark, opts) == [f"{opts.query}-{k:012d}" for k in (1, 3, 4)]
    assert read_dataset(spark, opts.base).count() == n
    assert fs.glob_names(spark, f"{sopts.checkpoint}/_staged/*") == set()


def test_without_intervals_a_batch_is_a_flush_and_without_data_nothing_is(spark):
    opts, sopts = place(spark, "flush_none", flush_batches=2)
    write = make_batch_writer(opts, sopts, EVENT_SCHEMA)
    write(rows(spark, 0), 0)
    assert write.tick(spark, ENVELOPE, True) == [] and commits(spark, opts) == []
    assert not StreamOptions(checkpoint="c", trigger={}).staged and not StreamOptions(checkpoint="c", trigger={}, flush_batches=1).staged
    for wrong in ({"flush_batches": -1}, {"flush_seconds": -1}, {"on_write_error": "maybe"}):
        with pytest.raises(ValueError):
            StreamOptions(checkpoint="c", trigger={}, **wrong)


def test_age_flushes_while_no_batch_comes(spark):
    opts, sopts = place(spark, "flush_age", flush_batches=100, flush_seconds=1.5)
    write = make_batch_writer(opts, sopts, EVENT_SCHEMA)
    write(rows(spark, 3), 0)
    assert commits(spark, opts) == []
    deadline = time.monotonic() + 60
    while not commits(spark, opts) and time.monotonic() < deadline:
        write.tick(spark, ENVELOPE)
        time.sleep(0.3)
    assert commits(spark, opts) == ["flush_age-000000000000"] and read_dataset(spark, opts.base).count() == 3


def test_redis_batches_are_landed_together(spark, store):  # noqa: F811
    fake, options = store
    opts, sopts = place(spark, "flush_redis")
    run = RunOptions(once=True, flush_interval_batches=3)
    for k in range(2):
        assert land_source(spark, "redis", options, opts, sopts, run, SCHEMA)["pending"] == 0
        assert landed(spark, opts) == {"s": (N + k, N + k), "l": (N, N)}
        fake.xadd_many("s", [(f"{9000 + k}-0", {"value": b'{"id": %d}' % (N + k)})])


class Fails:
    """``land`` that fails in its first calls, before or after it has written."""

    def __init__(self, monkeypatch, times, after=False):
        self.left, self.after, self.real = times, after, landing.land
        monkeypatch.setattr(landing, "land", self)

    def __call__(self, *a, **kw):
        if not self.left:
            return self.real(*a, **kw)
        self.left -= 1
        if self.after:
            self.real(*a, **kw)
        raise OSError("no space left")


@pytest.mark.parametrize("policy,after", [("log", False), ("log", True), ("ignore", False)])
def test_a_failed_flush_is_kept_and_lands_once_with_the_next(spark, monkeypatch, policy, after):
    opts, sopts = place(spark, f"flush_fail_{policy}{int(after)}", on_write_error=policy)
    write = make_batch_writer(opts, sopts, EVENT_SCHEMA)
    Fails(monkeypatch, 1, after)
    for k in range(3):
        write(rows(spark, 10, 10 * k), k)
        assert len(write.tick(spark, ENVELOPE)) == (1 if k == 0 and not after else 0)
    assert commits(spark, opts) == [f"{opts.query}-{k:012d}" for k in range(3)]
    assert read_dataset(spark, opts.base).count() == 30
    errors = staging.flush_errors(spark, sopts.checkpoint).collect()
    assert [(r.batch, r.error_type) for r in errors] == ([("0", "OSError")] if policy == "log" else [])
    assert all(r.attempt_at and "no space" in r.message for r in errors)


def test_a_flush_that_keeps_failing_is_reported_and_the_next_run_lands_it(spark, five_files, monkeypatch):
    options, n = five_files
    opts, sopts = place(spark, "flush_keeps", on_write_error="log")
    broken = Fails(monkeypatch, 10_000)
    run = RunOptions(once=True, flush_interval_batches=2)
    assert land_source(spark, "files", options, opts, sopts, run, EVENT_SCHEMA) == {"batches": 5, "rows": n, "pending": 3}
    assert commits(spark, opts) == []
    broken.left = 0
    assert land_source(spark, "files", options, opts, sopts, run, EVENT_SCHEMA) == {"batches": 0, "rows": 0, "pending": 0}
    assert commits(spark, opts) == [f"flush_keeps-{k:012d}" for k in (1, 3, 4)] and read_dataset(spark, opts.base).count() == n


def test_under_raise_the_run_ends_and_the_next_one_goes_on(spark, five_files, monkeypatch):
    options, n = five_files
    opts, sopts = place(spark, "flush_raise")
    broken = Fails(monkeypatch, 1)
    run = RunOptions(once=True, flush_interval_batches=2)
    with pytest.raises(Exception, match="no space left"):
        land_source(spark, "files", options, opts, sopts, run, EVENT_SCHEMA)
    assert broken.left == 0 and commits(spark, opts) == []
    land_source(spark, "files", options, opts, sopts, run, EVENT_SCHEMA)
    assert read_dataset(spark, opts.base).count() == n and len(commits(spark, opts)) == 3


@pytest.mark.parametrize("step", ["write_text", "seal", "landed", "cleared"])
def test_a_crash_at_each_step_loses_and_repeats_nothing(spark, monkeypatch, step):
    opts, sopts = place(spark, f"flush_crash_{step}", flush_batches=2)
    real_text, real_delete, seen = fs.create_text, fs.delete, []

    def text(s, path, t):
        at = {"write_text": "/ready=", "seal": "/flush=", "landed": "/done="}.get(step)
        if at and at in path and not seen:
            seen.append(path)
            raise KeyboardInterrupt
        return real_text(s, path, t)

    def delete(s, path):
        if step == "cleared" and "/epoch=" in path and len(seen) < 2:
            seen.append(path)
            if len(seen) == 2:  # one of two is gone
                raise KeyboardInterrupt
        return real_delete(s, path)

    monkeypatch.setattr(fs, "create_text", text)
    monkeypatch.setattr(fs, "delete", delete)
    for k in range(3):
        batch = rows(spark, 10, 10 * k)
        try:
            make_batch_writer(opts, sopts, EVENT_SCHEMA)(batch, k)
        except KeyboardInterrupt:
            make_batch_writer(opts, sopts, EVENT_SCHEMA)(batch, k)  # the restarted query's replay
    assert seen
    assert make_batch_writer(opts, sopts, EVENT_SCHEMA).tick(spark, ENVELOPE, True) == []
    assert read_dataset(spark, opts.base).count() == 30
    assert landing.counts(spark, sopts.checkpoint) == {"batches": 3, "rows": 30, "last": 2}
    assert fs.glob_names(spark, f"{sopts.checkpoint}/_staged/*") == set()


def test_a_flush_of_bad_rows_only_is_done_once(spark):
    opts, sopts = place(spark, "flush_bad", flush_batches=2)
    write = make_batch_writer(opts, sopts, EVENT_SCHEMA)
    for k in range(2):
        write(rows(spark, 2, 2 * k, "not json"), k)
    assert write.tick(spark, ENVELOPE) == [] and commits(spark, opts) == []
    assert spark.read.parquet(opts.quarantine_dir).count() == 4
    assert fs.glob_names(spark, f"{sopts.checkpoint}/_staged/*") == set()


def test_a_run_that_lands_directly_takes_what_was_staged_before(spark):
    opts, sopts = place(spark, "flush_switch", flush_batches=10)
    make_batch_writer(opts, sopts, EVENT_SCHEMA)(rows(spark, 4), 0)
    sopts.flush_batches = 0
    write = make_batch_writer(opts, sopts, EVENT_SCHEMA)
    write(rows(spark, 4), 0)
    write(rows(spark, 5, 10), 1)
    assert read_dataset(spark, opts.base).count() == 9 and len(commits(spark, opts)) == 2


def test_triggers_with_counts():
    assert trigger_of("files", {}, RunOptions(flush_interval_batches=3, flush_interval_seconds=60)) == {"processingTime": "0 seconds"}
    assert trigger_of("files", {}, RunOptions(flush_interval_seconds=60)) == {"processingTime": "60 seconds"}
