"""One-shot Redis runs: all that is there lands in one run, runs go on where the last one ended, failures lose and repeat nothing."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fake_redis import FileRedis
from siltbed.plans import fs
from siltbed.plans.land import LandOptions
from siltbed.plans.read import dataset_state, read_dataset
from siltbed.session import scratch_path
from siltbed.sources import redis as R
from siltbed.sources.dispatch import open_source
from siltbed.streaming import landing
from siltbed.streaming.landing import StreamOptions
from siltbed.streaming.run import RunOptions, land_source, trigger_of

N = 2500
SCHEMA = T.StructType([T.StructField("id", T.LongType())])


@pytest.fixture()
def store(tmp_path):
    path = str(tmp_path / "r.json")
    fake = FileRedis(path)
    fake.xadd_many("s", [(f"{1000 + i}-0", {"value": b'{"id": %d}' % i}) for i in range(N)])
    fake.rpush("l", *[b'{"id": %d}' % (10_000 + i) for i in range(N)])
    return fake, {"stream_keys": "s", "list_keys": "l", "consumer_group": "g", "batch_size": "1000", "client": "fake_redis:client", "fake_path": path}


def place(spark, name):
    return LandOptions(base=scratch_path(spark, name), query=name), StreamOptions(checkpoint=scratch_path(spark, name, "ckpt"), trigger={})


def landed(spark, opts):
    got = read_dataset(spark, opts.base).groupBy("_source_id").agg(F.count("*").alias("n"), F.countDistinct("id").alias("d")).collect()
    return {r["_source_id"]: (r.n, r.d) for r in got}


def test_one_run_lands_everything_and_the_next_only_what_is_new(spark, store):
    fake, options = store
    opts, sopts = place(spark, "drain")
    once = RunOptions(once=True)
    assert land_source(spark, "redis", options, opts, sopts, once, SCHEMA)["rows"] == 2 * N
    assert landed(spark, opts) == {"s": (N, N), "l": (N, N)}
    # the group and the lists stand where the landed rows end
    assert fake.group_last_id("s", "g") == fake.last_id("s")
    assert fake.lrange("l", 0, -1) == [] and fake.lrange("l:pending:g", 0, -1) == []
    assert land_source(spark, "redis", options, opts, sopts, once, SCHEMA)["rows"] == 0
    fake.xadd_many("s", [(f"{9000 + i}-0", {"value": b'{"id": %d}' % (N + i)}) for i in range(5)])
    fake.rpush("l", b'{"id": 99999}')
    assert land_source(spark, "redis", options, opts, sopts, once, SCHEMA)["rows"] == 6
    assert landed(spark, opts) == {"s": (N + 5, N + 5), "l": (N + 1, N + 1)}


def test_pages_of_one_run_each_go_on_from_the_last(spark, store):
    """availableNow without ``drain``: a page a run, and never the same one."""
    _, options = store
    opts, sopts = place(spark, "paged")
    sopts.trigger = {"availableNow": True}
    seen = []
    for _ in range(6):
        q = landing.start_landing(open_source(spark, "redis", options), opts, sopts, schema=SCHEMA)
        q.awaitTermination()
        assert q.exception() is None
        seen.append(sum(n for n, _ in landed(spark, opts).values()))
    assert seen == [1000, 2000, 3000, 4000, 5000, 5000]  # streams first, the lists get what they leave of the page
    assert landed(spark, opts) == {"s": (N, N), "l": (N, N)}


def test_a_run_that_fails_is_carried_on_without_loss_or_repeat(spark, store, monkeypatch):
    fake, options = store
    opts, sopts = place(spark, "failing")
    real = landing.land

    def dies_before(*a, **kw):
        raise OSError("died before the write")

    def dies_after(*a, **kw):
        real(*a, **kw)
        raise OSError("died after the commit record")

    for broken in (dies_before, dies_after):
        monkeypatch.setattr(landing, "land", broken)
        with pytest.raises(Exception, match="died"):
            land_source(spark, "redis", options, opts, sopts, RunOptions(once=True), SCHEMA)
        assert fake.group_last_id("s", "g") == "0-0"  # nothing is acknowledged
    monkeypatch.setattr(landing, "land", real)
    land_source(spark, "redis", options, opts, sopts, RunOptions(once=True), SCHEMA)
    assert landed(spark, opts) == {"s": (N, N), "l": (N, N)}
    assert dataset_state(spark, opts.base).commits.select("_batch_id").distinct().count() == 1


def test_a_lost_checkpoint_goes_back_to_the_acknowledged_position(spark, store):
    fake, options = store
    reader = R.RedisStreamReader(options)
    reader.latestOffset()
    planned = reader.latestOffset()  # planned twice, acknowledged never
    fresh = R.RedisStreamReader(options)
    assert fresh.initialOffset()["streams"] == {"s": "0-0"}
    ahead = fresh.latestOffset()
    assert R.entry_pair(ahead["streams"]["s"]) > R.entry_pair(planned["streams"]["s"])
    rows = [r for p in fresh.partitions(fresh.initialOffset(), ahead) for r in fresh.read(p)]
    assert len({r[3] for r in rows if r[0] == "redis_stream"}) == N


def test_positions_never_go_back(store):
    fake, options = store
    R.acknowledge(options, {"streams": {"s": "3000-0"}, "lists": {"l": 0}})
    R.acknowledge(options, '{"streams": {"s": "1500-0"}, "lists": {"l": 0}}')
    assert fake.group_last_id("s", "g") == "3000-0"
    fake.set_text("s:planned:g", "2000-0")  # behind the group, as another client moved that
    assert R.RedisStreamReader(options).latestOffset()["streams"]["s"] == "3499-0"


def test_partitions_are_bounded_in_number_and_hold_every_entry(store, monkeypatch):
    _, options = store
    monkeypatch.setattr(R, "MOST_PARTITIONS", 2)
    reader = R.RedisStreamReader({**options, "drain": "true"})
    end = reader.latestOffset()
    assert end is reader.latestOffset()  # fixed when the run began
    parts = reader.partitions(reader.initialOffset(), end)
    assert len(parts) == 4
    assert sum(len(list(reader.read(p))) for p in parts) == 2 * N


def test_a_deleted_tail_does_not_hold_the_planning_up(store):
    _, options = store
    reader = R.RedisStreamReader(options)
    assert reader.partitions({"streams": {"s": "3499-0"}, "lists": {}}, {"streams": {"s": "9999-0"}, "lists": {}}) == []


def test_triggers_of_sources():
    kafka = {"bootstrap_servers": ["b"], "topics": ["t"], "flush_interval_seconds": 30}
    assert trigger_of("kafka", kafka, RunOptions(once=True)) == {"availableNow": True}
    assert trigger_of("kafka", kafka, RunOptions()) == {"processingTime": "30 seconds"}
    assert trigger_of("redis", {}, RunOptions(once=True)) == {"availableNow": True}
    assert trigger_of("redis", {}, RunOptions(flush_interval_seconds=7)) == {"processingTime": "7 seconds"}
    assert trigger_of("files", {}, RunOptions()) == {"processingTime": "0 seconds"}


def test_files_run_from_options(spark, sf_dir):
    from siltbed.plans import fixtures as fx
    from siltbed.plans.catalog_decode import EVENT_SCHEMA

    src = scratch_path(spark, "run_files")
    fx.events_envelope(spark, sf_dir).write.parquet(src)
    opts, sopts = place(spark, "files_run")
    got = land_source(spark, "files", {"path": src}, opts, sopts, RunOptions(once=True), EVENT_SCHEMA)
    n = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert got == {"batches": 1, "rows": n} and read_dataset(spark, opts.base).count() == n
    assert fs.exists(spark, opts.commits_dir)
