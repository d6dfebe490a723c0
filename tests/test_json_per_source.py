"""Streams infer a schema for each source: types stay apart on disk, through replays, compaction and vacuum."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.plans import fs
from siltbed.plans.compact import CompactOptions, compact, vacuum
from siltbed.plans.land import LandOptions, read_commits
from siltbed.plans.read import read_dataset
from siltbed.session import scratch_path
from siltbed.streaming import landing as S
from test_regressions import envelope, writer


def q_types(spark, base, source):
    got = read_dataset(spark, base, sources=[source])
    return got.schema["q"].dataType.simpleString(), sorted(json.dumps(r.q if not hasattr(r.q, "asDict") else r.q.asDict()) for r in got.select("q").collect())


def test_types_of_sources_stay_apart_from_the_first_batch_to_vacuum(spark):
    opts, sopts, write = writer(spark, "per_source")
    one = envelope(spark, [("a", 0, 0, 0, '{"q": 1}'), ("b", 0, 1, 1, '{"q": {"k": 1}}'), (None, 0, 2, 2, '{"q": true}'), ("c", 0, 3, 3, "nope"), ("a", 0, 4, 4, "[]")])
    two = envelope(spark, [("a", 0, 5, 5, '{"q": 2, "late": "x"}'), ("b", 0, 6, 6, '{"q": {"k": 2, "m": 3}}'), ("d", 0, 7, 7, '{"q": "new"}')])
    for n, batch in enumerate((one, two)):
        write(batch, n)
        write(batch, n)  # a replay adds nothing
    want = {"a": ("bigint", ["1", "2"]), "default": ("boolean", ["true"]), "d": ("string", ['"new"'])}

    def check():
        for source, types in want.items():
            assert q_types(spark, opts.base, source) == types
        kind, values = q_types(spark, opts.base, "b")
        assert kind in ("struct<k:bigint,m:bigint>", "string") and len(values) == 2
        assert {"q", "late"} <= set(read_dataset(spark, opts.base, sources=["a"]).columns)
        assert read_dataset(spark, opts.base).count() == 6  # all sources at once: types that disagree are text

    assert spark.read.parquet(opts.quarantine_dir).count() == 2
    known = S.registry(spark, sopts.checkpoint)
    assert set(known) == {"a", "b", "d", S.UNTAGGED} and known["a"].simpleString() == "struct<q:bigint,late:string>"
    assert S.pinned_schema(spark, sopts.checkpoint, "d").simpleString() == "struct<q:string>"
    assert S.pinned_schema(spark, sopts.checkpoint)["q"].dataType == T.StringType()
    # one commit for each batch names every file with the schema that it was written in
    first = read_commits(spark, opts.base, "q-000000000000")
    assert first.select("schema_json").distinct().count() == 3 and first.count() == 3
    report = {r.dir: r.status for r in compact(spark, opts.base, CompactOptions(period="month")).collect()}
    assert report["_source_id=a"] == "merged" and report["_source_id=d"] == "below_min_files"
    check()  # both merged and landed files
    vacuum(spark, opts.base)
    assert read_dataset(spark, opts.base).count() == 6 and q_types(spark, opts.base, "a") == want["a"]


def test_a_registry_of_one_schema_goes_on_as_everyones_beginning(spark):
    opts, sopts, write = writer(spark, "old_registry")
    old = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.StringType())])
    fs.publish(spark, S._schema_dir(sopts.checkpoint), S.SCHEMAS, 0, json.dumps(old.jsonValue()))
    assert S.pinned_schema(spark, sopts.checkpoint, "a") == old
    write(envelope(spark, [("a", 0, 0, 0, '{"x": 1, "z": 2}'), ("b", 0, 1, 1, '{"x": "t"}')]), 0)
    known = S.registry(spark, sopts.checkpoint)
    assert known["a"].simpleString() == "struct<x:bigint,y:string,z:bigint>" and known["b"].simpleString() == "struct<x:string,y:string>"
    assert read_dataset(spark, opts.base, sources=["a"]).first()["x"] == 1


def test_a_batch_without_any_object_commits_nothing_and_keeps_its_bad_rows(spark):
    opts, sopts, write = writer(spark, "no_object")
    write(envelope(spark, [("a", 0, 0, 0, "5"), ("b", 0, 1, 1, None)]), 0)
    assert read_dataset(spark, opts.base).count() == 0
    assert {r.reason for r in spark.read.parquet(opts.quarantine_dir).collect()} == {"not_object", "null_value"}


def test_sources_with_signs_in_their_names(spark):
    opts = LandOptions(base=scratch_path(spark, "signs"), query="q")
    from siltbed.plans.land import land

    rows = spark.range(4).select(F.when(F.col("id") < 2, "s:a+b c/%").otherwise("plain").alias("_source_id"), "id")
    land([rows.where("id < 2"), rows.where("id >= 2").withColumn("more", F.lit(1))], opts, batch_seq=0)
    assert sorted(r.id for r in read_dataset(spark, opts.base, sources=["s:a+b c/%"]).collect()) == [0, 1]
    assert read_dataset(spark, opts.base, sources=["plain"]).columns == ["id", "more", "_source_id"]
