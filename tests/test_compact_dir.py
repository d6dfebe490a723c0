"""Merging folders of flush files in place; source types."""

import os

import pytest
from pyspark.sql import functions as F

from siltbed.plans import compact_dir as C
from siltbed.plans import fixtures as fx
from siltbed.plans import flush_dir as W
from siltbed.plans import fs, swap
from siltbed.sources.dispatch import open_source


def flush(spark, folder, name, rows):
    tmp = f"{folder}/.tmp"
    spark.createDataFrame(rows, "id long, value string").coalesce(1).write.mode("overwrite").parquet(tmp)
    part = next(p for p in os.listdir(tmp) if p.startswith("part-"))
    os.rename(f"{tmp}/{part}", f"{folder}/{name}")


def names(folder):
    return sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))


@pytest.fixture()
def tree(spark, tmp_path):
    for sub in ("", "topic1", "topic2/date=2024-01-01"):
        os.makedirs(tmp_path / sub, exist_ok=True)
        for k, hour in enumerate(["10", "10", "11"]):
            flush(spark, str(tmp_path / sub), f"data_20241113_{hour}{k:02d}00_{k:06d}.parquet", [(k, f"{sub}-{k}")])
    flush(spark, str(tmp_path), "data_x.parquet", [(99, "left alone")])
    flush(spark, str(tmp_path / "topic1"), "merged_20241113_09.parquet", [(98, "left alone")])
    return str(tmp_path)


def all_rows(spark, folder):
    return sorted((r.id, r.value) for r in spark.read.schema("id long, value string").option("recursiveFileLookup", "true").parquet(folder).collect())


def test_groups_of_each_folder_and_hour_are_merged(spark, tree):
    before = all_rows(spark, tree)
    report = {(r.dir, r.period_key): (r.n_files, r.n_rows) for r in C.compact_dir(spark, tree).collect()}
    assert report == {(d, "20241113_10"): (2, 2) for d in ("", "topic1", "topic2/date=2024-01-01")}
    assert all_rows(spark, tree) == before
    for sub in ("", "topic1", "topic2/date=2024-01-01"):
        left = names(os.path.join(tree, sub))
        assert sum(n.startswith("merged_20241113_10_") for n in left) == 1 and "data_20241113_110200_000002.parquet" in left
    assert "data_x.parquet" in names(tree) and "merged_20241113_09.parquet" in names(f"{tree}/topic1")
    assert C.compact_dir(spark, tree).collect() == [] and all_rows(spark, tree) == before
    assert not [d for d in os.listdir(tree) if d.startswith("_merge")]


@pytest.mark.parametrize("step", ["journal", "move", "delete"])
def test_a_merge_that_died_is_finished_or_undone(spark, tree, monkeypatch, step):
    """Before the journal is written, among the moves, among the deletes; and a folder without a journal."""
    before = all_rows(spark, tree)
    name, owner = {"journal": ("decide", swap), "move": ("move", fs), "delete": ("delete", fs)}[step]
    real, calls = getattr(owner, name), []

    def dies(*a, **kw):
        calls.append(a)
        if len(calls) > (0 if step == "journal" else 2):
            raise OSError("died")
        return real(*a, **kw)

    monkeypatch.setattr(owner, name, dies)
    with pytest.raises(OSError):
        C.compact_dir(spark, tree)
    monkeypatch.setattr(owner, name, real)
    os.makedirs(f"{tree}/_merge-dead/rows")  # one without a journal
    C.compact_dir(spark, tree)
    assert all_rows(spark, tree) == before
    assert not [d for d in os.listdir(tree) if d.startswith(("_merge", "_swap"))]
    for sub in ("", "topic1", "topic2/date=2024-01-01"):
        assert sum(n.startswith("merged_20241113_10_") for n in names(os.path.join(tree, sub))) == 1


def test_each_folder_keeps_its_own_schema_and_a_clash_is_reported(spark, tmp_path):
    def put(sub, k, df):
        os.makedirs(tmp_path / sub, exist_ok=True)
        df.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/.tmp")
        part = next(p for p in os.listdir(f"{tmp_path}/.tmp") if p.startswith("part-"))
        os.rename(f"{tmp_path}/.tmp/{part}", f"{tmp_path}/{sub}/data_20241113_10{k:02d}00_{k:06d}.parquet")

    one = spark.range(3)
    for k in range(2):
        put("a+b c", k, one.select(F.col("id").cast("int").alias("x")))
        put("b", k, one.select(F.col("id").cast("string").alias("x"), F.struct("id").alias("z")))
        put("wide", k, one.select(F.col("id").cast("int" if k else "double").alias("x"), *([F.lit(1).alias("y")] if k else [])))
        put("clash", k, one.select(F.col("id").cast("string").alias("x") if k else F.col("id").alias("x")))
        put("broken", k, one)
    (tmp_path / "broken" / "data_20241113_100100_000001.parquet").write_bytes(b"PAR1 no footer")
    got = {r.dir: (r.status, r.n_files, r.n_rows) for r in C.compact_dir(spark, str(tmp_path)).collect()}
    assert got == {"a+b c": ("merged", 2, 6), "b": ("merged", 2, 6), "wide": ("merged", 2, 6), "clash": ("schema_conflict", 2, None), "broken": ("unreadable", 2, None)}
    types = lambda sub: {f.name: f.dataType.simpleString() for f in spark.read.parquet(f"{tmp_path}/{sub}").schema.fields}
    assert types("a+b c") == {"x": "int"} and types("b") == {"x": "string", "z": "struct<id:bigint>"} and types("wide") == {"x": "double", "y": "int"}
    assert len(names(tmp_path / "clash")) == 2 and len(names(tmp_path / "broken")) == 2 and len(names(tmp_path / "a+b c")) == 1
    assert sorted(r.x for r in spark.read.parquet(f"{tmp_path}/a+b c").collect()) == [0, 0, 1, 1, 2, 2]


def test_flush_files_have_the_names_that_merging_knows(spark, tmp_path):
    rows = spark.range(40).select(F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("stream:"), F.col("id") % 2)).alias("_source_id"), "id", (F.col("id") % 3).alias("k"),
                                  F.floor(F.col("id") / 20).alias("blk"))
    at = spark.createDataFrame([(0, "2024-11-13 10:00:00"), (1, "2024-11-13 10:30:00")], "blk long, flush_ts string").withColumn("flush_ts", F.col("flush_ts").cast("timestamp"))
    folder = str(tmp_path)
    n = W.flush_files(rows, folder, "blk", at, partition_by=["k", "absent"])
    files = sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, fs_ in os.walk(folder) for f in fs_ if f.endswith(".parquet"))
    assert n == len(files) == 18 and files[0] == "default/k=0/data_20241113_100000_000000.parquet"
    report = C.compact_dir(spark, folder).collect()
    assert len(report) == 9 and {r.n_files for r in report} == {2} and sum(r.n_rows for r in report) == 40
    assert sorted(r.id for r in spark.read.option("recursiveFileLookup", "true").parquet(folder).collect()) == list(range(40))
    with pytest.raises(ValueError):
        W.flush_files(rows, folder, "blk", at.limit(1))
    assert spark.read.option("recursiveFileLookup", "true").parquet(folder).count() == 40


def test_unknown_source_types_are_refused(spark, sf_dir, tmp_path):
    with pytest.raises(ValueError, match="unsupported source type"):
        open_source(spark, "mqtt", {})
    with pytest.raises(ValueError):
        open_source(spark, "files", {})
    fx.events_envelope(spark, sf_dir).limit(5).write.parquet(str(tmp_path / "e"))
    assert open_source(spark, "files", {"path": str(tmp_path / "e")}, streaming=False).agg(F.count("*")).first()[0] == 5
