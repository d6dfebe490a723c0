"""Landing protocol, read-back and compaction on real files."""

import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from siltbed.functions.timeparts import with_time_partitions
from siltbed.plans import catalog_land as CL
from siltbed.plans import catalog_plan as CP
from siltbed.plans import fs
from siltbed.plans import land as L
from siltbed.plans.compact import CompactOptions, compact, vacuum
from siltbed.plans.land import LandOptions, _existing, batch_id_str, land, land_quarantine, read_commits
from siltbed.plans.read import dataset_state, read_dataset
from siltbed.session import scratch_path


@pytest.fixture(scope="module")
def good(spark, sf_dir):
    return with_time_partitions(CL._decoded(spark, sf_dir), "ts").cache()


def _local(p):
    return p.replace("file:", "")


def test_replay_is_idempotent_and_uncommitted_is_invisible(spark, good):
    opts = LandOptions(base=scratch_path(spark, "t_replay"), partition_by=["date"])
    n = good.count()
    land(good, opts, batch_seq=1)
    land(good, opts, batch_seq=1)
    assert read_dataset(spark, opts.base).count() == n
    # a crashed attempt: data written, no commit record -> not visible
    good.withColumn("_batch_id", F.lit("land-000000000002")).write.mode("append") \
        .partitionBy("_batch_id", "_source_id", "date").parquet(opts.land_dir)
    assert read_dataset(spark, opts.base).count() == n
    # the retry of that batch removes the leftovers and commits once
    land(good, opts, batch_seq=2)
    assert read_dataset(spark, opts.base).count() == 2 * n


def test_partition_columns_keep_types_and_absent_are_skipped(spark, good):
    opts = LandOptions(base=scratch_path(spark, "t_types"), partition_by=["nope", "date", "hour"])
    land(good, opts, batch_seq=1)
    back = read_dataset(spark, opts.base)
    types = dict(back.dtypes)
    assert types["date"] == "string" and types["hour"] == "int"
    leaf = [p for p, _ in fs.list_files(spark, opts.land_dir)][0]
    assert "/_source_id=" in leaf and "/date=" in leaf and "/hour=" in leaf and "nope=" not in leaf


def test_dictionary_and_codec_options_reach_the_files(spark, good):
    on = LandOptions(base=scratch_path(spark, "t_dict_on"), compression="zstd", dictionary=True)
    off = LandOptions(base=scratch_path(spark, "t_dict_off"), compression="gzip", dictionary=False)
    land(good, on, batch_seq=1)
    land(good, off, batch_seq=1)

    def encodings(opts):
        path = _local(fs.list_files(spark, opts.land_dir)[0][0])
        md = pq.ParquetFile(path).metadata
        col = md.row_group(0).column(0)
        return set(col.encodings), col.compression

    enc_on, codec_on = encodings(on)
    enc_off, codec_off = encodings(off)
    assert codec_on == "ZSTD" and codec_off == "GZIP"
    assert any("DICT" in e for e in enc_on)
    assert not any("DICT" in e for e in enc_off)


def test_brotli_refused_when_missing(spark, good):
    from siltbed.plans.land import check_codec_available

    with pytest.raises(ValueError, match="brotli"):
        check_codec_available(spark, "brotli")
    check_codec_available(spark, "zstd")


def test_unknown_codec_refused():
    with pytest.raises(ValueError):
        LandOptions(base="/x", compression="lzma")
    with pytest.raises(ValueError):
        LandOptions(base="")


def test_quarantine_is_landed_with_reason(spark, sf_dir):
    from siltbed.operators.decode import decode_json
    from siltbed.plans import fixtures as fx
    from siltbed.plans.catalog_decode import EVENT_SCHEMA
    from siltbed.sources.envelope import with_source

    opts = LandOptions(base=scratch_path(spark, "t_quarantine"))
    d = decode_json(with_source(fx.poison_envelope(spark, sf_dir)), EVENT_SCHEMA)
    land(d.good, opts, batch_seq=1)
    land_quarantine(d.quarantine, opts, batch_seq=1)
    land_quarantine(d.quarantine, opts, batch_seq=1)  # a replay replaces it
    q = spark.read.parquet(opts.quarantine_dir)
    total = fx.poison_envelope(spark, sf_dir).count()
    assert q.count() + read_dataset(spark, opts.base).count() == total
    assert {r[0] for r in q.select("reason").distinct().collect()} <= {"malformed", "not_object", "null_value"}


def test_compaction_twice_keeps_rows_and_reduces_files(spark, good):
    opts = LandOptions(base=scratch_path(spark, "t_compact"))
    rows = good.drop("date", "hour").withColumn("_blk", CL._block())
    land(rows, opts, batch_col="_blk", flush_ts=F.col("arrival_ts"))
    n = good.count()
    before = dataset_state(spark, opts.base).live_land.count()
    rep = compact(spark, opts.base, CompactOptions(period="month", min_files=2))
    assert rep.where("status = 'merged'").count() > 0
    st = dataset_state(spark, opts.base)
    assert st.live_land.count() + st.live_compacted.count() < before
    assert read_dataset(spark, opts.base).count() == n
    # land the same rows again as new batches, compact the same month: nothing lost, nothing doubled
    land(rows.withColumn("_blk", F.col("_blk") + 100000), opts, batch_col="_blk", flush_ts=F.col("arrival_ts"))
    compact(spark, opts.base, CompactOptions(period="month", min_files=2))
    assert read_dataset(spark, opts.base).count() == 2 * n
    assert vacuum(spark, opts.base) > 0
    assert read_dataset(spark, opts.base).count() == 2 * n


def test_conflicting_types_are_reported_and_left_alone(spark, good):
    opts = LandOptions(base=scratch_path(spark, "t_conflict"))
    a = good.drop("date", "hour").where(F.dayofmonth("ts") <= 15)
    b = good.drop("date", "hour").where(F.dayofmonth("ts") > 15).withColumn("user_id", F.col("user_id").cast("string"))
    land(a.withColumn("_blk", CL._block()), opts, batch_col="_blk", flush_ts=F.col("arrival_ts"))
    land(b.withColumn("_blk", CL._block()), opts, batch_col="_blk", flush_ts=F.col("arrival_ts"))
    rep = compact(spark, opts.base, CompactOptions(period="month", min_files=2))
    assert {r[0] for r in rep.select("status").distinct().collect()} == {"schema_conflict"}
    back = read_dataset(spark, opts.base)
    assert dict(back.dtypes)["user_id"] == "string"
    assert back.count() == good.count()


def test_commit_records_name_every_written_file(spark, good):
    opts = LandOptions(base=scratch_path(spark, "t_commits"), partition_by=["date"])
    commits = land(good, opts, batch_seq=3)
    listed = {p for p, _ in fs.list_files(spark, opts.land_dir)}
    assert {r["path"] for r in commits.collect()} == listed
    schema = json.loads(commits.first()["schema_json"])
    assert "date" in [f["name"] for f in schema["fields"]]


def test_unreadable_input_file_is_reported_and_the_rest_merged(spark, good):
    opts = LandOptions(base=scratch_path(spark, "t_corrupt"))
    rows = good.drop("date", "hour").withColumn("_blk", CL._block())
    land(rows, opts, batch_col="_blk", flush_ts=F.col("arrival_ts"))
    victim = _local(fs.list_files(spark, opts.land_dir)[0][0])
    with open(victim, "wb") as f:
        f.write(b"not parquet")
    rep = compact(spark, opts.base, CompactOptions(period="month", min_files=2)).collect()
    bad = [r for r in rep if r["status"] == "unreadable"]
    assert len(bad) == 1 and bad[0]["dir"] in victim
    st = dataset_state(spark, opts.base)
    assert st.live_land.count() == bad[0]["n_files"]  # every file of its group is still live
    merged = [r for r in rep if r["status"] == "merged"]
    counts = {f"_source_id={r[0]}": r[1] for r in good.groupBy("_source_id").count().collect()}
    assert merged and all(r["n_rows"] == counts[r["dir"]] for r in merged)


def test_bounded_compaction_round_defers_the_rest(spark, good):
    opts = LandOptions(base=scratch_path(spark, "t_bounded"))
    rows = good.drop("date", "hour").withColumn("_blk", CL._block())
    land(rows, opts, batch_col="_blk", flush_ts=F.col("arrival_ts"))
    rep = compact(spark, opts.base, CompactOptions(period="day", min_files=2, max_files=20)).collect()
    merged = [r for r in rep if r["status"] == "merged"]
    assert merged and sum(r["n_files"] for r in merged) <= 20 + max(r["n_files"] for r in merged)
    assert any(r["status"] == "deferred" for r in rep)
    assert read_dataset(spark, opts.base).count() == good.count()
    # the next round picks up what was deferred
    rep2 = compact(spark, opts.base, CompactOptions(period="day", min_files=2)).collect()
    assert not any(r["status"] == "deferred" for r in rep2)
    assert read_dataset(spark, opts.base).count() == good.count()


def test_monthly_load_files_are_ordered(spark, sf_dir):
    from siltbed.plans.catalog_land import monthly_sorted_load

    df = monthly_sorted_load(spark, sf_dir)
    files = {r[0] for r in df.select(F.input_file_name()).distinct().collect()}
    assert files
    for path in files:
        t = pq.read_table(_local(path)).to_pydict()
        keys = list(zip(t["ts"], t["user_id"]))
        assert keys == sorted(keys), path
    months = {r[0] for r in df.select("month").distinct().collect()}
    assert months == {"2024-01"}


def test_compaction_splits_a_large_period_by_target_size(spark, good):
    opts = LandOptions(base=scratch_path(spark, "t_target"))
    rows = good.drop("date", "hour").withColumn("_blk", CL._block())
    land(rows, opts, batch_col="_blk", flush_ts=F.col("arrival_ts"))
    total = sum(length for _, length in fs.list_files(spark, opts.land_dir))
    # a month per source is one group; a tiny target forces several files per group
    compact(spark, opts.base, CompactOptions(period="month", min_files=2, target_file_bytes=max(1, total // 40)))
    st = dataset_state(spark, opts.base)
    per_group = {r[0]: r[1] for r in st.live_compacted.groupBy("dir").count().collect()}
    assert per_group and all(n >= 2 for n in per_group.values())
    assert read_dataset(spark, opts.base).count() == good.count()


def test_many_batches_take_one_listing_and_a_record_file_each(spark, monkeypatch):
    opts = LandOptions(base=scratch_path(spark, "t_many"))
    rows = spark.range(0, 480, 1, 4).selectExpr("id", "id % 40 AS n", "concat('s', id % 3) AS _source_id", "timestamp_seconds(id) AS at")
    land(rows, opts, batch_col="n", flush_ts=F.col("at"))
    assert len(fs.list_files(spark, opts.land_dir)) == 120 and read_dataset(spark, opts.base).count() == 480
    assert len(fs.list_files(spark, opts.commits_dir, ".json")) == 40
    listings = []
    for name in ("glob_names", "names_in"):
        real = getattr(fs, name, None)
        monkeypatch.setattr(fs, name, lambda *a, real=real: listings.append(a) or real(*a), raising=False)
    ids = [batch_id_str(opts, i) for i in range(-5, 45)]
    assert _existing(spark, opts.land_dir, ids, chunk=10) == {f"_batch_id={batch_id_str(opts, i)}" for i in range(40)}
    assert len(listings) == 1
    assert _existing(spark, f"{opts.base}/absent", ids, chunk=10) == set() == _existing(spark, opts.land_dir, [], chunk=10)


def test_flush_files_holds_some_listings_at_a_time(spark, tmp_path, monkeypatch):
    """However many files the flushes have, no frame that is read lists more than the limit; all rows are counted."""
    events = spark.range(0, 6000, 1, 3).selectExpr(
        "id AS event_id", "timestampadd(SECOND, id, TIMESTAMP_NTZ '2024-01-01 00:00:00') AS ts", "id % 7 AS user_id",
        "concat('t', id % 3) AS event_type", "id / 2 AS value", "'{}' AS props")
    events.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(L, "FILES_AT_ONCE", 12, raising=False)
    monkeypatch.setattr(L, "FIRST_FOLDERS", 2, raising=False)
    held = []
    reader = type(spark.read)
    for name in ("parquet", "json", "load"):
        real = getattr(reader, name)

        def spied(self, *a, real=real, **kw):
            df = real(self, *a, **kw)
            held.append(sum("/_batch_id=" in f for f in df.inputFiles()))
            return df

        monkeypatch.setattr(reader, name, spied)
    got = {(r.flush_no, r._source_id): r.n_rows for r in CP.flush_files(spark, str(tmp_path)).collect()}
    # 60 full batches, 20 of each type, arrive in turns: 4 a flush
    ends = sorted((max(i for i in range(6000) if i % 3 == t and i // 300 == b), t) for t in range(3) for b in range(20))
    want = {}
    for n, (_, t) in enumerate(ends):
        want[(n // 4, f"t{t}")] = want.get((n // 4, f"t{t}"), 0) + 100
    assert got == want and len(got) > 36
    assert 0 < max(held) <= 12


def test_landing_lists_folders_in_parts_and_commits_all(spark, monkeypatch):
    monkeypatch.setattr(L, "FILES_AT_ONCE", 7)
    monkeypatch.setattr(L, "FIRST_FOLDERS", 2)
    opts = LandOptions(base=scratch_path(spark, "t_parts"))
    odd = "CASE id % 3 WHEN 0 THEN 'a+b c/%' WHEN 1 THEN 's:x#y?\u00fc' END"  # and no source
    rows = spark.range(0, 600, 1, 4).selectExpr("id", "id % 20 AS n", f"{odd} AS _source_id", "timestamp_micros(id * 1234567) AS at")
    landed = land(rows, opts, batch_col="n", flush_ts=F.col("at"))
    listed = {p: n for p, n in fs.list_files(spark, opts.land_dir)}
    assert {r["path"]: r["length"] for r in landed.collect()} == listed and len(listed) == 60
    assert sorted(landed.collect()) == sorted(read_commits(spark, opts.base).collect())
    groups = list(L.batch_groups(landed))
    assert [len(g) for g in groups] == [2] * 10 and sum(groups, []) == [batch_id_str(opts, i) for i in range(20)]
    assert [len(g) for g in L.batch_groups(landed, 2)] == [1] * 20
    parts = [read_dataset(spark, opts.base, include_internal=True, batches=g) for g in groups]
    assert sum(p.count() for p in parts) == 600
    assert sorted(r.id for p in parts for r in p.collect()) == list(range(600))
    assert {r[0] for r in parts[3].select("_batch_id").distinct().collect()} == set(groups[3])
    # a batch that is compacted is not read as a batch
    compact(spark, opts.base, CompactOptions(period="month", min_files=2))
    assert read_dataset(spark, opts.base, batches=groups[0]).count() == 0 and read_dataset(spark, opts.base).count() == 600
    assert read_dataset(spark, opts.base, batches=[]).count() == 0


def test_settings_for_many_folders_are_put_back(spark):
    keys = ("spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.hive.filesourcePartitionFileCacheSize")
    before = [spark.conf.get(k) for k in keys]
    with pytest.raises(ValueError), fs.many_folders(spark):
        assert [spark.conf.get(k) for k in keys] == [str(fs.FEW_TASKS), "0"]
        raise ValueError
    assert [spark.conf.get(k) for k in keys] == before
