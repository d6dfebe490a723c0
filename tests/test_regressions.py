"""Cases that were once wrong: ordinals with payload columns, untagged rows, half-written manifests, replays, types of other
sources, names that clash, mistyped payloads, schema inference, list commits."""

import datetime as dt
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fake_redis import FileRedis
from siltbed.operators import batching as B
from siltbed.operators import decode as D
from siltbed.operators.metrics import metrics_by_source
from siltbed.operators.ordinal import with_ordinal
from siltbed.plans import fixtures as fx
from siltbed.plans import fs
from siltbed.plans.compact import CompactOptions, compact, vacuum
from siltbed.plans.land import LandOptions, land, land_quarantine
from siltbed.plans.read import dataset_state, latest_version, manifest_dir, read_dataset
from siltbed.session import scratch_path
from siltbed.sources import redis as R
from siltbed.sources.envelope import ENVELOPE, SOURCE_COL, with_source
from siltbed.streaming.landing import StreamOptions, make_batch_writer, pinned_schema

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def envelope(spark, rows):
    """rows: (topic, partition, offset, seconds or None, value)"""
    return spark.createDataFrame([("kafka", t, None, p, o, None if s is None else T0 + dt.timedelta(seconds=s), None if v is None else v.encode())
                                  for t, p, o, s, v in rows], ENVELOPE)


def test_ordinals_are_right_with_payload_columns(spark, sf_dir):
    env = with_source(fx.events_envelope(spark, sf_dir))
    got = with_ordinal(env, ["arrival_ts", "partition", "offset"], [SOURCE_COL], name="pos", num_partitions=7).collect()
    want = {}
    for r in sorted(got, key=lambda r: (r[SOURCE_COL], r["arrival_ts"], r["partition"], r["offset"])):
        want[r[SOURCE_COL]] = want.get(r[SOURCE_COL], 0) + 1
        assert r["pos"] == want[r[SOURCE_COL]]
        assert r["value"] is not None


def test_untagged_and_timeless_rows_stay(spark):
    env = with_source(envelope(spark, [(None if i % 10 == 0 else "a", 0, i, None if i % 7 == 0 else i, "{}") for i in range(100)]))
    rows, ordered = B.plan_batches(env, 8)
    assert rows.count() == 100
    assert B.limit_batches(rows, ordered, None).count() == 100
    per = metrics_by_source(ordered, env.select(SOURCE_COL, "kind").distinct(), "local").collect()
    assert {r[SOURCE_COL]: r["n_records"] for r in per} == {None: 10, "a": 90}
    assert sum(r["n_rows"] for r in B.flush_by_time(env, 10).collect()) == 100


def test_batches_follow_arrival_over_partitions(spark):
    env = with_source(envelope(spark, [("a", i % 2, i // 2 + 1000 * (i % 2), i, "{}") for i in range(20)]))
    rows = B.assign_batches(env, 5).collect()
    assert all(r["batch_seq"] == int((r["arrival_ts"].replace(tzinfo=dt.timezone.utc) - T0).total_seconds()) // 5 for r in rows)


def test_planned_flushes_are_landed(spark):
    env = with_source(envelope(spark, [("ab"[i % 2], 0, i, i, "{}") for i in range(60)]))
    opts = LandOptions(base=scratch_path(spark, "r_flush"))
    land(B.plan_flushes(env, 5, 4), opts, batch_col="flush_no", flush_ts=F.col("arrival_ts"))
    st = dataset_state(spark, opts.base)
    assert st.commits.select("_batch_id").distinct().count() == 3
    assert read_dataset(spark, opts.base).count() == 60


def lake(spark, name, n=200, blocks=4, query="land"):
    opts = LandOptions(base=scratch_path(spark, name), query=query)
    rows = spark.range(n).select(F.lit("s").alias(SOURCE_COL), "id", (F.col("id") % blocks).alias("_blk"),
                                 F.lit(T0).alias("at"))
    land(rows, opts, batch_col="_blk", flush_ts=F.col("at"))
    return opts, rows


def test_unfinished_manifest_is_passed_over(spark):
    opts, _ = lake(spark, "r_manifest")
    compact(spark, opts.base, CompactOptions(period="day"))
    assert vacuum(spark, opts.base) > 0
    n = latest_version(spark, opts.base)
    folder = manifest_dir(opts.base)
    spark.range(1).select(F.lit("{").alias("value")).write.text(f"{folder}/rows-dead/_temporary")  # a killed writer's rows
    f, p = fs._fs(spark, f"{folder}/v={n + 1:012d}")
    f.create(p, False).close()  # and its empty version
    assert latest_version(spark, opts.base) == n
    assert read_dataset(spark, opts.base).count() == 200
    # the next rounds are not blocked by it
    land(spark.range(50).select(F.lit("s").alias(SOURCE_COL), "id", (F.col("id") % 3).alias("_blk"), F.lit(T0).alias("at"))
         .withColumn("_blk", F.col("_blk") + 10), opts, batch_col="_blk", flush_ts=F.col("at"))
    compact(spark, opts.base, CompactOptions(period="day"))
    assert latest_version(spark, opts.base) == n + 2
    assert read_dataset(spark, opts.base).count() == 250


def test_crashed_round_leaves_only_an_orphan_that_vacuum_clears(spark):
    opts, _ = lake(spark, "r_orphan")
    spark.range(5).write.parquet(f"{opts.base}/compacted/v=dead")
    compact(spark, opts.base, CompactOptions(period="day"))
    assert read_dataset(spark, opts.base).count() == 200
    vacuum(spark, opts.base)
    assert fs.exists(spark, f"{opts.base}/compacted/v=dead")  # younger than a day: may be at work
    vacuum(spark, opts.base, orphan_seconds=-60)
    assert not fs.exists(spark, f"{opts.base}/compacted/v=dead")
    assert read_dataset(spark, opts.base).count() == 200


def test_replay_after_vacuum_adds_nothing(spark):
    opts, rows = lake(spark, "r_vacuum")
    compact(spark, opts.base, CompactOptions(period="day"))
    assert vacuum(spark, opts.base) > 0
    land(rows, opts, batch_col="_blk", flush_ts=F.col("at"))
    land(rows.drop("_blk"), opts, batch_seq=2)
    assert read_dataset(spark, opts.base).count() == 200
    land(rows.withColumn("_blk", F.col("_blk") + 100), opts, batch_col="_blk", flush_ts=F.col("at"))
    assert read_dataset(spark, opts.base).count() == 400


def test_compaction_keeps_each_sources_types(spark):
    opts = LandOptions(base=scratch_path(spark, "r_types"))
    a = spark.range(8).select(F.lit("a").alias(SOURCE_COL), F.struct("id").alias("v"))
    b = spark.range(8).select(F.lit("b").alias(SOURCE_COL), F.col("id").alias("v"), F.lit(1).alias("only_b"))
    for i in range(2):
        land(a, opts, batch_seq=2 * i)
        land(b, opts, batch_seq=2 * i + 1)
    report = compact(spark, opts.base, CompactOptions(period="month")).collect()
    assert {(r["dir"], r["status"], r["n_rows"]) for r in report} == {("_source_id=a", "merged", 16), ("_source_id=b", "merged", 16)}
    kinds = {}
    for r in dataset_state(spark, opts.base).live_compacted.collect():
        kinds[r["dir"]] = {f["name"]: f["type"] for f in json.loads(r["schema_json"])["fields"]}
        stored = spark.read.parquet(r["path"])
        assert isinstance(stored.schema["v"].dataType, T.StructType if r["dir"].endswith("a") else T.LongType)
        assert ("only_b" in stored.columns) == r["dir"].endswith("b")
    assert read_dataset(spark, opts.base).count() == 32


def test_rows_outside_the_plan_are_refused(spark):
    opts = LandOptions(base=scratch_path(spark, "r_plan"))
    rows = spark.range(20).select(F.lit("s").alias(SOURCE_COL), "id", (F.col("id") % 4).alias("_blk"))
    short = spark.createDataFrame([(0, T0), (1, T0)], "_blk long, flush_ts timestamp")
    with pytest.raises(RuntimeError, match="nothing was committed"):
        land(rows, opts, batch_col="_blk", batches=short)
    assert read_dataset(spark, opts.base).count() == 0
    with pytest.raises(ValueError, match="without a batch number"):
        land(rows.withColumn("_blk", F.nullif("_blk", F.lit(3))), opts, batch_col="_blk")


def writer(spark, name, **kw):
    opts = LandOptions(base=scratch_path(spark, name), query="q")
    sopts = StreamOptions(checkpoint=scratch_path(spark, f"{name}_ckpt"), trigger={"availableNow": True}, **kw)
    return opts, sopts, make_batch_writer(opts, sopts, None)


def test_replayed_micro_batch_returns_and_has_its_quarantine(spark):
    opts, sopts, write = writer(spark, "r_replay")
    batch = envelope(spark, [("a", 0, i, i, '{"x": 1}' if i % 2 else "nope") for i in range(6)])
    write(batch, 0)
    write(batch, 0)
    assert read_dataset(spark, opts.base).count() == 3
    assert spark.read.parquet(opts.quarantine_dir).count() == 3


def test_late_keys_and_types_widen_the_streams_schema(spark):
    opts, sopts, write = writer(spark, "r_late")
    write(envelope(spark, [("a", 0, 0, 0, "5")]), 0)  # a prefix without an object
    write(envelope(spark, [("a", 0, 1, 1, '{"x": 1, "y": null}')]), 1)
    write(envelope(spark, [("a", 0, 2, 2, '{"x": 2, "y": "hello", "z": "new"}')]), 2)
    rows = {r["offset"]: r for r in read_dataset(spark, opts.base).collect()}
    assert (rows[2]["x"], rows[2]["y"], rows[2]["z"]) == (2, "hello", "new")
    assert rows[1]["y"] is None and rows[1]["z"] is None
    assert [f.name for f in pinned_schema(spark, sopts.checkpoint).fields] == ["x", "y", "z"]
    assert spark.read.parquet(opts.quarantine_dir).select("reason").collect() == [("not_object",)]


def test_payload_fields_named_like_the_envelope(spark):
    env = envelope(spark, [("a", 3, 7, 0, '{"offset": 99, "kind": "k", "arrival_ts": "x", "partition": 1}')])
    d, _ = D.decode_json_inferred(with_source(env))
    opts = LandOptions(base=scratch_path(spark, "r_clash"))
    land(d.good, opts, batch_seq=1)
    r = read_dataset(spark, opts.base).first()
    assert (r["offset"], r["kind"], r["_meta_offset"], r["_meta_partition"]) == (99, "k", 7, 3)


def test_inference_edge_cases(spark):
    env = with_source(envelope(spark, [("a", 0, 0, 0, '\n {"VARIANT": 1, "n": null, "d": 1.5, "OBJECT<": {"q": 1}}'), ("a", 0, 1, 1, '{"m": 1}'), ("a", 0, 2, 2, '{"m": "s"}'),
                                       ("b", 0, 3, 3, '{"m": true}')]))
    kinds = {f.name: f.dataType.simpleString() for f in D.infer_json_schema(env.where(F.col(SOURCE_COL) == "a")).fields}
    assert kinds == {"VARIANT": "bigint", "n": "string", "d": "double", "OBJECT<": "struct<q:bigint>", "m": "string"}
    per = D.infer_json_schemas(env)
    assert per["b"].simpleString() == "struct<m:boolean>"
    decoded = D.decode_json_per_source(env)
    assert decoded["b"][0].good.first()["m"] is True and decoded["a"][0].good.count() == 3
    bad = D.decode_json(with_source(envelope(spark, [("a", 0, 0, 0, '\n{"m": "x"}')])), T.StructType([T.StructField("m", T.LongType())]))
    assert bad.quarantine.first()["reason"] == "schema_mismatch"


def ipc(**columns):
    t = pa.table(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as w:
        w.write_table(t)
    return bytearray(sink.getvalue().to_pybytes())


def test_a_mistyped_ipc_payload_is_quarantined_alone(spark):
    rows = [("kafka", "a", None, 0, i, T0, v) for i, v in enumerate([ipc(x=[1, 2]), ipc(x=["no"]), bytearray(b"junk"), None, ipc(y=[1]), ipc(x=pa.array([], pa.int64()))])]
    env = with_source(spark.createDataFrame(rows, ENVELOPE))
    schema = T.StructType([T.StructField("x", T.LongType())])
    d = D.decode_arrow_ipc(env, schema)
    assert sorted((r["offset"], r["x"]) for r in d.good.collect() if r["x"]) == [(0, 1), (0, 2)]
    assert {r["offset"]: r["reason"] for r in d.quarantine.collect()} == {1: "bad_ipc", 2: "bad_ipc", 3: "null_value"}
    with pytest.raises(Exception):
        D.decode_arrow_ipc(env, schema, policy="raise").good.collect()
    assert D.decode_arrow_ipc(env, schema, policy="ignore").quarantine.count() == 0


def test_quarantine_of_a_backfill_is_replaced_by_its_replay(spark):
    opts = LandOptions(base=scratch_path(spark, "r_backfill"))
    bad = with_source(envelope(spark, [("a", 0, i, i, "x") for i in range(4)])).withColumn("reason", F.lit("malformed")).withColumn("b", F.col("offset") % 2)
    for _ in range(2):
        land_quarantine(bad, opts, batch_col="b")
    assert spark.read.parquet(opts.quarantine_dir).count() == 4


def test_timestamps_are_written_in_microseconds(spark):
    import pyarrow.parquet as pq

    opts = LandOptions(base=scratch_path(spark, "r_micros"))
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    land(spark.range(3).select(F.lit("s").alias(SOURCE_COL), F.lit(T0).alias("at")), opts, batch_seq=1)
    path = fs.list_files(spark, opts.land_dir)[0][0].replace("file:", "")
    assert str(pq.read_schema(path).field("at").type).startswith("timestamp[us")


def test_redis_reads_are_bounded_split_and_compared_by_pairs(tmp_path):
    path = str(tmp_path / "r.json")
    fake = FileRedis(path)
    fake.xadd_many("s", [(f"1-{n}", {"value": b"{}"}) for n in [0, 5, 1 << 20, (1 << 20) + 1]])
    fake.xadd_many("t", [(f"{i}-0", {"value": b"{}"}) for i in range(1, 2501)])
    fake.rpush("l", *[str(i).encode() for i in range(10)])
    r = R.RedisStreamReader({"stream_keys": "s,t", "list_keys": "l", "consumer_group": "g", "batch_size": "3", "client": "fake_redis:client", "fake_path": path})
    a = r.initialOffset()
    b = r.latestOffset()
    assert b["streams"] == {"s": f"1-{1 << 20}", "t": "3-0"} and b["lists"] == {"l": 0}  # the streams took the whole budget
    c = r.latestOffset()
    assert c["streams"]["s"] == f"1-{(1 << 20) + 1}"
    ids = [row[3] for p in r.partitions(b, c) if p.key == "s" for row in r.read(p)]
    assert ids == [f"1-{(1 << 20) + 1}"]
    big = {"streams": {"s": c["streams"]["s"], "t": "2500-0"}, "lists": {"l": 0}}
    parts = [p for p in r.partitions(a, big) if p.key == "t"]
    assert len(parts) == 3 and sum(len(list(r.read(p))) for p in parts) == 2500


def test_list_commit_is_one_step(tmp_path):
    path = str(tmp_path / "r.json")
    fake = FileRedis(path)
    fake.rpush("l", *[str(i).encode() for i in range(6)])
    opts = {"list_keys": "l", "batch_size": "2", "client": "fake_redis:client", "fake_path": path}
    r = R.RedisStreamReader(opts)
    start, seen = r.initialOffset(), []
    for _ in range(4):
        end = r.latestOffset()
        seen += [row[5]["value"] for p in r.partitions(start, end) for row in r.read(p)]
        r.commit(end)
        r.commit(end)  # a repeated commit trims nothing more
        start = end
        r = R.RedisStreamReader(opts)  # a restart
    assert seen == [str(i).encode() for i in range(6)]
    assert all(row[4] is not None for p in r.partitions({"streams": {}, "lists": {}}, end) for row in r.read(p))
