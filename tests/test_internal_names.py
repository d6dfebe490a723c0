"""Payload columns of the layout's own names, and the per-column check before a compaction is published."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.operators import decode as D
from siltbed.plans import compact as C
from siltbed.plans import fs
from siltbed.plans.compact import CompactOptions, compact, vacuum
from siltbed.plans.internal import INTERNAL, payload_name, stored_name
from siltbed.plans.land import LandOptions, land, read_commits
from siltbed.plans.read import dataset_state, latest_version, read_dataset
from siltbed.session import scratch_path
from siltbed.sources.envelope import SOURCE_COL

DAY = CompactOptions(period="day")
NAMES = ["v", "_period", "_batch_id", "_version", "_PERIOD2", "_payload__period", "_payload__payload__period"]


def rows(spark, lo, hi):
    return spark.range(lo, hi).select(F.lit("s").alias(SOURCE_COL), "id", *(F.concat(F.lit(f"{n}-"), "id").alias(n) for n in NAMES))


def by_id(spark, base):
    return {r["id"]: tuple(r[n] for n in NAMES) for r in read_dataset(spark, base).collect()}


def test_names_are_told_apart():
    names = [*INTERNAL, *NAMES, "_Batch_ID", "v", "id", "_payload_", "_payload_x"]
    assert len({stored_name(n).lower() for n in names}) == len({n.lower() for n in names})
    assert all(payload_name(stored_name(n)) == n for n in names)
    assert all(stored_name(n).lower() not in INTERNAL for n in names)


def test_such_columns_survive_landing_two_compactions_and_vacuum(spark):
    opts = LandOptions(base=scratch_path(spark, "names"))
    for k in range(2):
        land(rows(spark, k * 10, k * 10 + 10), opts, batch_seq=k)
    want = {i: tuple(f"{n}-{i}" for n in NAMES) for i in range(40)}
    assert by_id(spark, opts.base) == {i: want[i] for i in range(20)}
    compact(spark, opts.base, DAY)
    for k in range(2, 4):
        land(rows(spark, k * 10, k * 10 + 10), opts, batch_seq=k)
    compact(spark, opts.base, DAY)  # the first one's rows are folded in again
    assert dataset_state(spark, opts.base).live_compacted.select("schema_json").first()[0].count("payload_name") == 5
    assert vacuum(spark, opts.base) > 0
    assert by_id(spark, opts.base) == want
    inside = read_dataset(spark, opts.base, include_internal=True)
    assert {"_period", "_payload__period", "_payload__payload__period"} <= set(inside.columns)
    assert '"payload_name": "_period"' in dataset_state(spark, opts.base).live_compacted.first()["schema_json"]


def test_a_partition_column_of_such_a_name(spark):
    opts = LandOptions(base=scratch_path(spark, "names_part"), partition_by=["_period", "absent"])
    for k in range(2):
        land(rows(spark, 0, 6).withColumn("_period", F.col("id") % 3), opts, batch_seq=k)
    compact(spark, opts.base, DAY)
    got = read_dataset(spark, opts.base)
    assert got.schema["_period"].dataType == T.LongType()
    assert {r["_period"]: r["count"] for r in got.groupBy("_period").count().collect()} == {0: 4, 1: 4, 2: 4}


def test_routing_follows_the_tag_not_a_field_of_its_name(spark):
    env = spark.createDataFrame([("a", 0, 1, None, bytearray(b'{"_source_id": "b", "_corrupt_record": 7, "_field__source_id": 1}'))],
                                "topic string, partition int, offset long, arrival_ts timestamp, value binary").withColumn("kind", F.lit("kafka")).withColumn("stream_key", F.lit(None).cast("string"))
    schema = T.StructType([T.StructField("_source_id", T.StringType()), T.StructField("_corrupt_record", T.LongType()), T.StructField("_field__source_id", T.LongType())])
    good = D.decode_json(env, schema).good
    opts = LandOptions(base=scratch_path(spark, "names_tag"))
    land(good, opts, batch_seq=1)
    r = read_dataset(spark, opts.base).first()
    assert (r["_source_id"], r["_field__source_id"], r["_corrupt_record"], r["_field__field__source_id"]) == ("a", "b", 7, 1)
    assert "/_source_id=a/" in read_commits(spark, opts.base).first()["path"]


def test_folders_of_an_older_layout_are_read_and_folded_in(spark):
    """Version folders were called v=<id>: their files are read, alone and beside new ones, and the next round takes them in."""
    opts = LandOptions(base=scratch_path(spark, "names_old"))
    plain = lambda lo, hi: spark.range(lo, hi).select(F.lit("s").alias(SOURCE_COL), "id", F.col("id").alias("w"))
    for k in range(2):
        land(plain(k * 10, k * 10 + 10), opts, batch_seq=k)
    compact(spark, opts.base, DAY)
    made = fs.list_dirs(spark, f"{opts.base}/compacted")[0]
    fs.rename(spark, f"{opts.base}/compacted/{made}", f"{opts.base}/compacted/v=old")
    st = dataset_state(spark, opts.base)
    moved = st.manifest.withColumn("path", F.regexp_replace("path", f"/compacted/{made}/", "/compacted/v=old/"))
    C.publish_manifest(spark, opts.base, latest_version(spark, opts.base), C.cut_lineage(moved))
    assert sorted(r.w for r in read_dataset(spark, opts.base).collect()) == list(range(20))
    for k in range(2, 4):
        land(plain(k * 10, k * 10 + 10).withColumn("v", F.lit("mine")), opts, batch_seq=k)
    compact(spark, opts.base, DAY)
    got = read_dataset(spark, opts.base)
    assert sorted((r.id, r.w, r.v) for r in got.where("v is not null").collect()) == [(i, i, "mine") for i in range(20, 40)]
    assert got.count() == 40 and vacuum(spark, opts.base) > 0
    assert sorted(r.w for r in read_dataset(spark, opts.base).collect()) == list(range(40))


def test_a_column_that_is_lost_or_changed_is_not_published(spark, monkeypatch):
    opts = LandOptions(base=scratch_path(spark, "names_check"))
    for k in range(2):
        land(rows(spark, k * 10, k * 10 + 10), opts, batch_seq=k)
    real = C.union_widened
    for broken in (lambda df: df.withColumn("v", F.lit(None).cast("string")), lambda df: df.withColumn("v", F.concat("v", F.lit("!")))):
        monkeypatch.setattr(C, "union_widened", lambda frames, b=broken: b(real(frames)))
        monkeypatch.setattr(C, "_paths_by", lambda files, key, f=C._paths_by: {k: v for k, v in f(files, key).items()})
        from siltbed.plans.land import land as again
        again(rows(spark, 50, 55).withColumn("extra", F.lit(1)), opts, batch_seq=9)  # a second schema, so that frames are united
        with pytest.raises(RuntimeError, match="not published"):
            compact(spark, opts.base, DAY)
        assert latest_version(spark, opts.base) == 0
    monkeypatch.undo()
    compact(spark, opts.base, DAY)
    assert latest_version(spark, opts.base) == 1 and len(by_id(spark, opts.base)) == 25


def test_checksums_cover_nested_and_widened_columns(spark):
    opts = LandOptions(base=scratch_path(spark, "names_nested"))
    one = spark.range(5).select(F.lit("s").alias(SOURCE_COL), F.col("id").cast("int").alias("n"), F.struct("id").alias("o"), F.create_map(F.lit("k"), "id").alias("m"), F.array("id").alias("a"),
                                F.lit(float("nan")).alias("f"), F.lit(b"x").alias("b"))
    land(one, opts, batch_seq=1)
    land(one.withColumn("n", F.col("n").cast("long") + 2**40).drop("a"), opts, batch_seq=2)
    report = compact(spark, opts.base, DAY).collect()
    assert [(r.status, r.n_rows) for r in report] == [("merged", 10)]
    assert read_dataset(spark, opts.base).agg(F.sum("n")).first()[0] == 2 * 10 + 5 * 2**40
