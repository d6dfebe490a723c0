"""The Redis data source against a file-backed fake (no server): streams through a consumer
group, lists through a pending list, commit after the batch, resume without re-reading."""

import os

import pytest
from pyspark.sql import functions as F

from siltbed.operators.decode import decode_json
from siltbed.plans.catalog_decode import EVENT_SCHEMA
from siltbed.session import scratch_path
from siltbed.sources import redis as R
from siltbed.sources.envelope import TS_NTZ_MICROS, from_redis, with_source
from fake_redis import FileRedis


@pytest.fixture()
def store(spark, sf_dir, tmp_path):
    path = str(tmp_path / "redis.json")
    fake = FileRedis(path)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    payload = F.to_json(F.struct("event_id", "ts", "user_id", "value", "props"), {"timestampNTZFormat": TS_NTZ_MICROS})
    rows = ev.select("event_id", "event_type", payload.alias("v")).orderBy("event_id").collect()
    by_key = {}
    for r in rows:
        fields = {"source": b"producer"} if r["event_id"] % 10 == 9 else {"value": r["v"].encode()}
        by_key.setdefault(f"stream:{r['event_type']}", []).append((f"{1700000000000 + r['event_id']}-0", fields))
    for k, entries in by_key.items():
        fake.xadd_many(k, entries)
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.to_json(F.struct("*")).alias("v")).collect()
    fake.rpush("conversations", *[r["v"].encode() for r in conv])
    return path, sorted(by_key), len(rows), len(conv)


def _options(path, keys, group="g1"):
    return {"stream_keys": ",".join(keys), "list_keys": "conversations", "consumer_group": group,
            "batch_size": "50", "client": "fake_redis:client", "fake_path": path}


def _drain(spark, opts, out, checkpoint):
    """Run the source into a Parquet file sink until idle; returns all rows the sink holds."""
    R.register(spark)
    stream = spark.readStream.format("siltbed_redis").options(**opts).load()
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .trigger(processingTime="1 second").start())
    q.processAllAvailable()
    q.stop()
    return spark.read.parquet(out)


def test_stream_and_list_drain_commit_and_resume(spark, store):
    path, keys, n_events, n_conv = store
    ckpt, sink = scratch_path(spark, "redis_ckpt"), scratch_path(spark, "redis_sink")
    out = _drain(spark, _options(path, keys), sink, ckpt)
    assert out.where("kind = 'redis_stream'").count() == n_events
    assert out.where("kind = 'redis_list'").count() == n_conv
    # Spark commits a batch to the source when it plans the next one: the source's state may
    # trail by at most the last trigger (at-least-once across checkpoints), never run ahead
    fake = FileRedis(path)
    for k in keys:
        assert R.entry_seq(fake.group_last_id(k, "g1")) <= R.entry_seq(fake.last_id(k))
    assert len(fake.lrange("conversations:pending:g1", 0, -1)) <= 50
    assert fake.lrange("conversations", 0, -1) == []
    # entries without a value field are quarantined, not lost
    env = with_source(from_redis(out.where("kind = 'redis_stream'")))
    d = decode_json(env, EVENT_SCHEMA)
    assert d.good.count() + d.quarantine.count() == n_events
    assert {r[0] for r in d.quarantine.select("reason").distinct().collect()} == {"null_value"}
    # restarting from the same checkpoint reads nothing twice (exactly once within a checkpoint)
    again = _drain(spark, _options(path, keys), sink, ckpt)
    assert again.count() == n_events + n_conv


def test_consumer_group_required_for_streams(store):
    path, keys, _, _ = store
    opts = _options(path, keys)
    del opts["consumer_group"]
    with pytest.raises(ValueError, match="consumer_group"):
        R.RedisStreamReader(opts)
    lists_only = {k: v for k, v in opts.items() if k != "stream_keys"}
    R.RedisStreamReader(lists_only)  # lists need no group


def test_batch_read_sees_everything_without_consuming(spark, store):
    path, keys, n_events, n_conv = store
    R.register(spark)
    df = spark.read.format("siltbed_redis").options(**_options(path, keys)).load()
    assert df.count() == n_events + n_conv
    assert FileRedis(path).lrange("conversations", 0, -1) != []


def test_entry_ids_order_and_time():
    assert R.entry_seq("1700000000000-2") > R.entry_seq("1700000000000-1") > R.entry_seq("1699999999999-9")
    assert R.id_time("1700000000000-0").year == 2023


def test_read_failure_is_an_error_not_an_empty_poll(spark, tmp_path):
    opts = {"list_keys": "q", "client": "fake_redis:client",
            "fake_path": str(tmp_path / "missing" / "x.json")}
    R.register(spark)
    with pytest.raises(Exception):
        spark.read.format("siltbed_redis").options(**opts).load().count()
    assert not os.path.exists(str(tmp_path / "missing"))
