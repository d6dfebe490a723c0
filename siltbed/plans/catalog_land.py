"""Registered queries that land real files, compact them and read them back
(W1 W4 W8 P1-P5 B8 S9 M7-M13 Q1-Q5 D5). Every query writes under a fresh folder in the
shared checkpoint location and returns a DataFrame over what it wrote."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.timeparts import with_time_partitions
from siltbed.operators.decode import decode_arrow_ipc, decode_json, decode_json_inferred, encode_arrow_ipc
from siltbed.plans import fixtures as fx
from siltbed.plans.catalog_decode import EVENT_SCHEMA
from siltbed.plans.compact_dir import compact_dir, list_folder, schemas_of
from siltbed.plans.flush_dir import flush_files
from siltbed.plans.compact import CompactOptions, compact, plan as compact_plan, vacuum
from siltbed.plans.land import LandOptions, land
from siltbed.plans.read import dataset_state, read_dataset
from siltbed.plans.registry import register
from siltbed.session import scratch_path
from siltbed.sources.envelope import ENVELOPE, SOURCE_COL, from_table, with_source
from siltbed.streaming.landing import StreamOptions, await_landing, start_landing

ROW_COLS = [SOURCE_COL, "offset", "event_id", "ts", "user_id", "value", "props"]
ROWS_SQL = """SELECT event_type AS _source_id, event_id AS "offset", event_id, ts, user_id, "value", props FROM events"""
SINCE = "2024-01-15"
BLOCK_SECONDS = 6 * 3600


def _decoded(spark, sf_dir, envelope=fx.events_envelope):
    return decode_json(with_source(envelope(spark, sf_dir)), EVENT_SCHEMA).good


def _land_events(spark, sf_dir, name, partition_by=("date",), **kw):
    opts = LandOptions(base=scratch_path(spark, name), partition_by=list(partition_by), **kw)
    good = with_time_partitions(_decoded(spark, sf_dir), "ts")
    land(good, opts, batch_seq=1)
    return opts


@register("land_events", """
SELECT event_type AS _source_id, strftime(ts, '%Y-%m-%d') AS "date", count(*) AS n_events,
       min(event_id) AS min_event_id, max(event_id) AS max_event_id FROM events GROUP BY 1, 2""")
def land_events(spark, sf_dir):
    opts = _land_events(spark, sf_dir, "land_events")
    back = read_dataset(spark, opts.base)
    return back.groupBy(SOURCE_COL, "date").agg(F.count(F.lit(1)).alias("n_events"),
                                                F.min("event_id").alias("min_event_id"),
                                                F.max("event_id").alias("max_event_id"))


@register("read_back", """
SELECT event_type AS _source_id, strftime(ts, '%Y-%m-%d') AS "date", event_id AS "offset", event_id, ts, user_id,
       "value", props FROM events""")
def read_back(spark, sf_dir):
    opts = _land_events(spark, sf_dir, "read_back")
    return read_dataset(spark, opts.base).select(*ROW_COLS, "date")


@register("event_counts_since", f"""
SELECT event_type, count(*) AS n_events FROM events WHERE strftime(ts, '%Y-%m-%d') >= '{SINCE}' GROUP BY 1""")
def event_counts_since(spark, sf_dir):
    opts = _land_events(spark, sf_dir, "event_counts_since")
    back = read_dataset(spark, opts.base)
    return (back.where(F.col("date") >= F.lit(SINCE)).groupBy(F.col(SOURCE_COL).alias("event_type"))
            .agg(F.count(F.lit(1)).alias("n_events")))


@register("event_counts_writeback", """SELECT event_type, count(*) AS n_events FROM events GROUP BY 1""")
def event_counts_writeback(spark, sf_dir):
    opts = _land_events(spark, sf_dir, "event_counts_writeback")
    out = f"{opts.base}/reports/event_counts"
    counts = read_dataset(spark, opts.base).groupBy(F.col(SOURCE_COL).alias("event_type")).agg(
        F.count(F.lit(1)).alias("n_events"))
    counts.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


@register("monthly_sorted_load", """
SELECT strftime(ts, '%Y-%m') AS "month", event_id, ts, user_id, event_type, "value", props FROM events""")
def monthly_sorted_load(spark, sf_dir):
    opts = _land_events(spark, sf_dir, "monthly_sorted_load")
    out = f"{opts.base}/tables/events_by_month"
    rows = read_dataset(spark, opts.base).select(
        "event_id", "ts", "user_id", F.col(SOURCE_COL).alias("event_type"), "value", "props",
        F.date_format("ts", "yyyy-MM").alias("month"))
    # cluster by month (range-split, so a big month is several tasks), order by (ts, user_id) inside files
    (rows.repartitionByRange("month", "ts", "user_id").sortWithinPartitions("month", "ts", "user_id")
     .write.mode("overwrite").partitionBy("month").parquet(out))
    return spark.read.schema(rows.schema).parquet(out)


@register("typed_load", """
SELECT event_id AS id, event_type AS name, ts AS "timestamp", "value" FROM events""")
def typed_load(spark, sf_dir):
    # land with an inferred schema (ISO timestamps stay strings), then load into declared types
    decoded, _ = decode_json_inferred(with_source(fx.events_envelope(spark, sf_dir)))
    opts = LandOptions(base=scratch_path(spark, "typed_load"))
    land(decoded.good, opts, batch_seq=1)
    back = read_dataset(spark, opts.base)
    return back.select(F.col("event_id").cast("long").alias("id"), F.col(SOURCE_COL).alias("name"),
                       F.try_to_timestamp(F.col("ts"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
                       .cast("timestamp_ntz").alias("timestamp"),
                       F.col("value").cast("double").alias("value"))


@register("route_by_source", """
SELECT CASE WHEN event_id % 6 IN (0, 3) THEN 'stream:' || event_type ELSE event_type END AS _source_id,
       count(*) AS n_events FROM events GROUP BY 1""")
def route_by_source(spark, sf_dir):
    opts = LandOptions(base=scratch_path(spark, "route_by_source"))
    land(_decoded(spark, sf_dir, fx.precedence_envelope), opts, batch_seq=1)
    return read_dataset(spark, opts.base).groupBy(SOURCE_COL).agg(F.count(F.lit(1)).alias("n_events"))


@register("partition_by_cols", """
SELECT event_type AS _source_id, strftime(ts, '%Y-%m-%d') AS "date", CAST(hour(ts) AS INTEGER) AS "hour",
       count(*) AS n_events FROM events GROUP BY 1, 2, 3""")
def partition_by_cols(spark, sf_dir):
    opts = _land_events(spark, sf_dir, "partition_by_cols", partition_by=("date", "hour"))
    return read_dataset(spark, opts.base).groupBy(SOURCE_COL, "date", "hour").agg(
        F.count(F.lit(1)).alias("n_events"))


@register("partition_missing_col", """
SELECT event_type AS _source_id, strftime(ts, '%Y-%m-%d') AS "date", count(*) AS n_events FROM events GROUP BY 1, 2""")
def partition_missing_col(spark, sf_dir):
    opts = _land_events(spark, sf_dir, "partition_missing_col", partition_by=("region", "date"))
    return read_dataset(spark, opts.base).groupBy(SOURCE_COL, "date").agg(F.count(F.lit(1)).alias("n_events"))


def _tier():
    """A partition value that is null on some rows and '' on others (both read back as null)."""
    return (F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string"))
            .when(F.col("event_id") % 7 == 1, F.lit(""))
            .when(F.col("user_id") % 2 == 0, F.lit("even")).otherwise(F.lit("odd")))


@register("partition_null", """
SELECT event_type AS _source_id,
       CASE WHEN event_id % 7 IN (0, 1) THEN NULL WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS tier,
       count(*) AS n_events FROM events GROUP BY 1, 2""")
def partition_null(spark, sf_dir):
    opts = LandOptions(base=scratch_path(spark, "partition_null"), partition_by=["tier"])
    land(_decoded(spark, sf_dir).withColumn("tier", _tier()), opts, batch_seq=1)
    return read_dataset(spark, opts.base).groupBy(SOURCE_COL, "tier").agg(F.count(F.lit(1)).alias("n_events"))


@register("partition_type_roundtrip", """
SELECT strftime(ts, '%Y-%m-%d') AS "date", CAST(day(ts) AS INTEGER) AS day_num, 'string' AS date_type,
       'int' AS day_num_type, count(*) AS n_events FROM events GROUP BY 1, 2""")
def partition_type_roundtrip(spark, sf_dir):
    opts = LandOptions(base=scratch_path(spark, "partition_type_roundtrip"), partition_by=["date", "day_num"])
    good = with_time_partitions(_decoded(spark, sf_dir), "ts", hour_col=None).withColumn(
        "day_num", F.dayofmonth("ts").cast("int"))
    land(good, opts, batch_seq=1)
    back = read_dataset(spark, opts.base)
    return back.groupBy("date", "day_num", F.typeof("date").alias("date_type"),
                        F.typeof("day_num").alias("day_num_type")).agg(F.count(F.lit(1)).alias("n_events"))


CODECS_TRIED = ["snappy", "gzip", "zstd", "none"]


@register("codec_roundtrip", """
SELECT c.codec, e.event_type AS _source_id, count(*) AS n_events, CAST(sum(e.user_id) AS BIGINT) AS sum_user_id
FROM events e, (VALUES ('snappy'), ('gzip'), ('zstd'), ('none')) c(codec) GROUP BY 1, 2""")
def codec_roundtrip(spark, sf_dir):
    good = _decoded(spark, sf_dir)
    frames = []
    for codec in CODECS_TRIED:
        opts = LandOptions(base=scratch_path(spark, f"codec_{codec}"), compression=codec)
        land(good, opts, batch_seq=1)
        # a data file's name ends in its codec's extension, as the writer chose it
        name = F.regexp_extract(F.input_file_name(), r"\.(snappy|gz|zstd)\.parquet$", 1)
        stored = F.when(name == "gz", "gzip").when(name == "", "none").otherwise(name)
        frames.append(read_dataset(spark, opts.base).withColumn("codec", stored))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.groupBy("codec", SOURCE_COL).agg(F.count(F.lit(1)).alias("n_events"),
                                                F.sum("user_id").cast("long").alias("sum_user_id"))


@register("idempotent_replay", """SELECT event_type AS _source_id, count(*) AS n_events FROM events GROUP BY 1""")
def idempotent_replay(spark, sf_dir):
    opts = LandOptions(base=scratch_path(spark, "idempotent_replay"), partition_by=["date"])
    good = with_time_partitions(_decoded(spark, sf_dir), "ts")
    land(good, opts, batch_seq=7)
    land(good, opts, batch_seq=7)  # the same batch again (a retried flush): replaces itself
    return read_dataset(spark, opts.base).groupBy(SOURCE_COL).agg(F.count(F.lit(1)).alias("n_events"))


# ---- compaction -------------------------------------------------------------------------------

def _block(ts="arrival_ts"):
    """Planned flushes of a backfill: 6-hour blocks of arrival time."""
    return F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / F.lit(BLOCK_SECONDS)).cast("long")


def block_plan(env):
    """Planned flushes from the envelope alone: block number and its last arrival (flush time)."""
    return env.groupBy(_block().alias("_blk")).agg(F.max("arrival_ts").alias("flush_ts"))


def _land_blocks(spark, name, good, partition_by=(), env=None):
    opts = LandOptions(base=scratch_path(spark, name), partition_by=list(partition_by))
    plan = block_plan(env) if env is not None else None
    land(good.withColumn("_blk", _block()), opts, batch_col="_blk", flush_ts=F.col("arrival_ts"), batches=plan)
    return opts


_REPORT_SQL = f"""
WITH b AS (SELECT event_type, CAST(floor(epoch(ts) / {BLOCK_SECONDS}) AS BIGINT) AS bn, ts FROM events),
     f AS (SELECT bn, max(ts) AS fts FROM b GROUP BY bn),
     files AS (SELECT DISTINCT b.event_type, b.bn, strftime(f.fts, '%Y%m%d') AS pk FROM b JOIN f USING (bn))
SELECT '_source_id=' || event_type AS dir, pk AS period_key, count(*) AS n_files,
       CASE WHEN count(*) >= 2 THEN 'merged' ELSE 'below_min_files' END AS status FROM files GROUP BY 1, 2"""


def _merged(spark, opts):
    """Rows, and whether compaction did its work: a manifest version, and landed files folded into fewer live ones."""
    st = dataset_state(spark, opts.base)
    folded = st.manifest.where("kind = 'folded'").count()
    done = st.version > 0 and 0 < st.live_compacted.count() < folded
    return read_dataset(spark, opts.base).withColumn("compacted", F.lit(done))


MERGED_SQL = ROWS_SQL.replace("props FROM", "props, true AS compacted FROM")


@register("merge_compact", MERGED_SQL)
def merge_compact(spark, sf_dir):
    opts = _land_blocks(spark, "merge_compact", _decoded(spark, sf_dir), env=fx.events_envelope(spark, sf_dir))
    compact(spark, opts.base, CompactOptions(period="day", min_files=2))
    return _merged(spark, opts).select(*ROW_COLS, "compacted")


@register("merge_report", _REPORT_SQL)
def merge_report(spark, sf_dir):
    opts = _land_blocks(spark, "merge_report", _decoded(spark, sf_dir), env=fx.events_envelope(spark, sf_dir))
    return compact(spark, opts.base, CompactOptions(period="day", min_files=2)).select(
        "dir", "period_key", "n_files", "status")


@register("merge_plan_files", _REPORT_SQL.replace("'merged'", "'planned'"))
def merge_plan_files(spark, sf_dir):
    """The plan alone (nothing written by compaction): groups of landed files per folder and day."""
    opts = _land_blocks(spark, "merge_plan_files", _decoded(spark, sf_dir))
    _st, _landed, groups = compact_plan(spark, opts.base, CompactOptions(period="day", min_files=2))
    return groups.select("dir", "period_key", "n_files",
                         F.when(F.col("status") == "merged", F.lit("planned")).otherwise(F.col("status")).alias("status"))


@register("merge_twice", MERGED_SQL)
def merge_twice(spark, sf_dir):
    good = _decoded(spark, sf_dir)
    opts = LandOptions(base=scratch_path(spark, "merge_twice"))
    first = good.where(F.dayofmonth("ts") <= 15).withColumn("_blk", _block())
    second = good.where(F.dayofmonth("ts") > 15).withColumn("_blk", _block())
    month = CompactOptions(period="month", min_files=2)
    land(first, opts, batch_col="_blk", flush_ts=F.col("arrival_ts"))
    compact(spark, opts.base, month)
    land(second, opts, batch_col="_blk", flush_ts=F.col("arrival_ts"))
    compact(spark, opts.base, month)  # same month again: folds the first compaction in
    return _merged(spark, opts).select(*ROW_COLS, "compacted")


#: Payload fields called like the layout's own columns, or like what those are stored under.
CLASHING = {"event_id": "event_id", "v": "user_id", "_period": "event_type", "_batch_id": "value", "_Version": "props", "_payload__period": "user_id"}


@register("payload_internal_names", """
SELECT event_type AS _source_id, event_id, user_id AS v, event_type AS _period, "value" AS _batch_id, props AS "_Version",
       user_id AS _payload__period, event_type AS _field__source_id, true AS compacted, true AS vacuumed FROM events""")
def payload_internal_names(spark, sf_dir):
    """Such fields through landing, two compactions of the same period and the removal of the files they came from."""
    ev = fx.table(spark, sf_dir, "events").withColumn("tag", F.col("event_type"))
    payload = ev.select("event_type", F.col("ts").alias("at"), *[F.col(c).alias(name) for name, c in CLASHING.items()], F.col("tag").alias(SOURCE_COL))
    env = from_table(payload, topic=F.col("event_type"), offset=F.col("event_id"), arrival_ts=F.col("at"), payload=[*CLASHING, SOURCE_COL])
    fields = [T.StructField(name, ev.schema[c].dataType) for name, c in CLASHING.items()] + [T.StructField(SOURCE_COL, T.StringType())]
    good = decode_json(with_source(env), T.StructType(fields)).good.withColumn("_blk", _block())
    opts = LandOptions(base=scratch_path(spark, "payload_internal_names"))
    month = CompactOptions(period="month", min_files=2)
    for half in (F.dayofmonth("arrival_ts") <= 15, F.dayofmonth("arrival_ts") > 15):
        land(good.where(half), opts, batch_col="_blk", flush_ts=F.col("arrival_ts"))
        compact(spark, opts.base, month)
    st = dataset_state(spark, opts.base)
    done = st.version > 1 and 0 < st.live_compacted.count() < st.manifest.where("kind = 'folded'").count()
    removed = vacuum(spark, opts.base)
    return read_dataset(spark, opts.base).select(SOURCE_COL, *CLASHING, f"_field_{SOURCE_COL}", F.lit(done).alias("compacted"), F.lit(removed > 0).alias("vacuumed"))


@register("merge_dir", """
SELECT event_type AS _source_id, event_id, CAST(user_id AS VARCHAR) AS user_id,
       CASE WHEN event_type = 'purchase' THEN 'x' || CAST(event_id AS VARCHAR) END AS extra,
       CASE WHEN event_type = 'view' OR event_type = 'error' AND day(ts) // 8 % 2 = 1 THEN 'string' ELSE 'bigint' END AS user_id_type,
       CASE WHEN event_type = 'error' THEN 'schema_conflict' ELSE 'merged' END AS status FROM events""")
def merge_dir(spark, sf_dir):
    """Folders of flush files merged in place: one source has other types, one another column, one types that clash between its files."""
    ev = fx.table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    rows = ev.select(F.col("event_type").alias(SOURCE_COL), "event_id", "user_id", at.alias("arrival_ts"), F.floor(F.dayofmonth("ts") / 8).cast("long").alias("flush_no"))
    times = rows.groupBy("flush_no").agg(F.max("arrival_ts").alias("flush_ts"))
    folder = scratch_path(spark, "merge_dir")
    kind = F.col(SOURCE_COL)
    plain = rows.drop("arrival_ts")
    text = plain.withColumn("user_id", F.col("user_id").cast("string"))
    mixed = F.col("flush_no") % 2 == 1
    flush_files(plain.where(kind.isin("click", "signup") | ((kind == "error") & ~mixed)), folder, "flush_no", times)
    flush_files(text.where((kind == "view") | ((kind == "error") & mixed)), folder, "flush_no", times)
    flush_files(plain.where(kind == "purchase").withColumn("extra", F.concat(F.lit("x"), F.col("event_id").cast("string"))), folder, "flush_no", times)
    report = compact_dir(spark, folder, period="month").select(F.col("dir").alias(SOURCE_COL), "status")
    frames = []
    for source in ("click", "signup", "view", "purchase"):
        got = spark.read.parquet(f"{folder}/{source}")  # in the types that are on disk
        extra = F.col("extra") if "extra" in got.columns else F.lit(None).cast("string")
        frames.append(got.select(F.lit(source).alias(SOURCE_COL), "event_id", F.col("user_id").cast("string"), extra.alias("extra"), F.typeof("user_id").alias("user_id_type")))
    # files of types that clash are left as they were: each is read by its own footer
    by: dict[str, list[str]] = {}
    for path, schema in schemas_of(list_folder(spark, folder).where("dir = 'error'")).select("path", "schema_json").collect():
        by.setdefault(schema, []).append(path)
    for schema, paths in by.items():
        left = spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*paths)
        frames.append(left.select(F.lit("error").alias(SOURCE_COL), "event_id", F.col("user_id").cast("string"), F.lit(None).cast("string").alias("extra"), F.typeof("user_id").alias("user_id_type")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.join(report, SOURCE_COL)


@register("merge_schema_evolution", """
SELECT event_type AS _source_id, event_id, CASE WHEN day(ts) > 15 THEN 'x' || CAST(event_id AS VARCHAR) END AS extra,
       true AS compacted FROM events""")
def merge_schema_evolution(spark, sf_dir):
    good = _decoded(spark, sf_dir)
    opts = LandOptions(base=scratch_path(spark, "merge_schema_evolution"))
    early = good.where(F.dayofmonth("ts") <= 15).withColumn("_blk", _block())
    late = (good.where(F.dayofmonth("ts") > 15).withColumn("extra", F.concat(F.lit("x"), F.col("event_id").cast("string")))
            .withColumn("_blk", _block()))
    land(early, opts, batch_col="_blk", flush_ts=F.col("arrival_ts"))
    land(late, opts, batch_col="_blk", flush_ts=F.col("arrival_ts"))
    compact(spark, opts.base, CompactOptions(period="month", min_files=2))
    return _merged(spark, opts).select(SOURCE_COL, "event_id", "extra", "compacted")


@register("merge_publish", """SELECT event_type AS _source_id, count(*) AS n_events, true AS vacuumed FROM events GROUP BY 1""")
def merge_publish(spark, sf_dir):
    opts = _land_blocks(spark, "merge_publish", _decoded(spark, sf_dir))
    compact(spark, opts.base, CompactOptions(period="day", min_files=2))
    removed = vacuum(spark, opts.base)  # folded landed files are gone; the manifest still reads whole
    st = dataset_state(spark, opts.base)
    return read_dataset(spark, opts.base).groupBy(SOURCE_COL).agg(F.count(F.lit(1)).alias("n_events")).withColumn(
        "vacuumed", F.lit(removed > 0 and st.live_compacted.count() > 0))


# ---- streaming ---------------------------------------------------------------------------------

STREAM_FILES = 16
FILES_PER_TRIGGER = 4


def _envelope_files(spark, sf_dir, name):
    """The envelope landed as files in offset order (the runnable stand-in for a broker log)."""
    path = scratch_path(spark, name, "envelope")
    fx.events_envelope(spark, sf_dir).repartitionByRange(STREAM_FILES, "offset").write.parquet(path)
    return path


def _stream_land(spark, sf_dir, name, compact_every=0):
    src = _envelope_files(spark, sf_dir, name)
    opts = LandOptions(base=scratch_path(spark, name, "lake"), partition_by=["date"], query=name)
    sopts = StreamOptions(checkpoint=scratch_path(spark, name, "checkpoint"), trigger={"availableNow": True},
                          compact_every=compact_every, compact=CompactOptions(period="day", min_files=2),
                          time_partitions_from="ts")
    stream = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(src)
    q = start_landing(stream, opts, sopts, schema=EVENT_SCHEMA)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return opts


@register("one_shot_drain", """SELECT event_type AS _source_id, count(*) AS n_events FROM events GROUP BY 1""")
def one_shot_drain(spark, sf_dir):
    opts = _stream_land(spark, sf_dir, "one_shot_drain")
    return read_dataset(spark, opts.base).groupBy(SOURCE_COL).agg(F.count(F.lit(1)).alias("n_events"))


@register("staged_flushes", """
SELECT event_type AS _source_id, count(*) AS n_events, CAST(3 AS BIGINT) AS n_flushes FROM events GROUP BY 1""")
def staged_flushes(spark, sf_dir):
    """Five micro-batches, landed two at a time: three flushes, told apart by their commits."""
    src = scratch_path(spark, "staged_flushes", "envelope")
    fx.events_envelope(spark, sf_dir).repartitionByRange(5, "offset").write.parquet(src)
    opts = LandOptions(base=scratch_path(spark, "staged_flushes", "lake"), query="staged_flushes")
    sopts = StreamOptions(checkpoint=scratch_path(spark, "staged_flushes", "checkpoint"), trigger={"availableNow": True}, flush_batches=2)
    await_landing(start_landing(spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(src), opts, sopts, EVENT_SCHEMA))
    n_flushes = dataset_state(spark, opts.base).commits.agg(F.countDistinct("_batch_id").alias("n_flushes"))
    return read_dataset(spark, opts.base).groupBy(SOURCE_COL).agg(F.count(F.lit(1)).alias("n_events")).join(F.broadcast(n_flushes))


@register("json_per_source", """
SELECT event_type AS _source_id, event_id, CASE event_type WHEN 'click' THEN 'bigint' WHEN 'view' THEN 'struct<k:bigint>' WHEN 'error' THEN 'double' ELSE 'string' END AS q_type,
       CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) WHEN 'view' THEN '{"k":' || CAST(user_id AS VARCHAR) || '}'
            WHEN 'error' THEN CAST(user_id + 0.5 AS VARCHAR) ELSE 'u' || CAST(user_id AS VARCHAR) END AS q,
       CASE WHEN event_type = 'signup' AND event_id % 2 = 0 THEN event_id END AS late FROM events""")
def json_per_source(spark, sf_dir):
    """A stream whose sources disagree on a key's type, landed with inferred schemas, merged and read source by source."""
    ev = fx.table(spark, sf_dir, "events")
    kind, q = F.col("event_type"), F.col("user_id").cast("string")
    q = (F.when(kind == "click", q).when(kind == "view", F.concat(F.lit('{"k":'), q, F.lit("}")))
         .when(kind == "error", F.concat(q, F.lit(".5"))).otherwise(F.concat(F.lit('"u'), q, F.lit('"'))))
    late = F.when((kind == "signup") & (F.col("event_id") % 2 == 0), F.concat(F.lit(', "late": '), "event_id")).otherwise(F.lit(""))
    value = F.concat(F.lit('{"event_id": '), "event_id", F.lit(', "q": '), q, late, F.lit("}"))
    env = fx.events_envelope(spark, sf_dir).drop("value").join(ev.select(F.col("event_id").alias("offset"), value.cast("binary").alias("value")), "offset").select(*ENVELOPE.names)
    src = scratch_path(spark, "json_per_source", "envelope")
    env.repartitionByRange(4, "offset").write.parquet(src)
    opts = LandOptions(base=scratch_path(spark, "json_per_source", "lake"), query="json_per_source")
    sopts = StreamOptions(checkpoint=scratch_path(spark, "json_per_source", "checkpoint"), trigger={"availableNow": True})
    q = start_landing(spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 2).parquet(src), opts, sopts)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    compact(spark, opts.base, CompactOptions(period="month", min_files=2))
    frames = []
    for (source,) in ev.select("event_type").distinct().collect():
        got = read_dataset(spark, opts.base, sources=[source])
        value = F.to_json("q") if isinstance(got.schema["q"].dataType, T.StructType) else F.col("q").cast("string")
        late = F.col("late") if "late" in got.columns else F.lit(None).cast("long")
        frames.append(got.select(SOURCE_COL, "event_id", F.typeof("q").alias("q_type"), value.alias("q"), late.alias("late")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("merge_on_flush", MERGED_SQL)
def merge_on_flush(spark, sf_dir):
    opts = _stream_land(spark, sf_dir, "merge_on_flush", compact_every=2)
    return _merged(spark, opts).select(*ROW_COLS, "compacted")


# ---- Arrow IPC payloads ------------------------------------------------------------------------

IPC_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType()),
                           T.StructField("props", T.StringType())])


@register("arrow_ipc_decode", """
SELECT event_type AS _source_id, event_id, ts, user_id, "value", props FROM events WHERE (event_id // 100) % 20 <> 19""")
def arrow_ipc_decode(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    blocks = encode_arrow_ipc(ev, F.floor(F.col("event_id") / 100), ["event_type"], [f.name for f in IPC_SCHEMA.fields])
    env = blocks.select(
        F.lit("kafka").alias("kind"), F.col("event_type").alias("topic"), F.lit(None).cast("string").alias("stream_key"),
        F.lit(0).alias("partition"), F.col("_block").alias("offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("arrival_ts"),
        F.when(F.col("_block") % 20 == 19, F.lit("garbage").cast("binary")).otherwise(F.col("payload")).alias("value"))
    d = decode_arrow_ipc(with_source(env), IPC_SCHEMA)
    return d.good.select(SOURCE_COL, "event_id", "ts", "user_id", "value", "props")
