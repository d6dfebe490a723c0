"""Registered queries: batch / flush planning, drift union, metrics, period keys, merge planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltbed.functions.names import flush_file_name
from siltbed.operators import batching as B
from siltbed.operators.metrics import metrics_by_source
from siltbed.operators.unions import union_widened
from siltbed.plans import compact_plan as CP
from siltbed.plans import fixtures as fx
from siltbed.plans import fs
from siltbed.plans.land import LandOptions, batch_groups, land
from siltbed.plans.read import read_dataset
from siltbed.plans.registry import register
from siltbed.session import scratch_path
from siltbed.sources.envelope import SOURCE_COL, with_source

BATCH_SIZE = 100
FLUSH_EVERY = 4
FLUSH_SECONDS = 300
MAX_BATCHES = 25
FLUSH_FILES = f"flush_no long, {SOURCE_COL} string, n_rows long"

_BATCHES_SQL = f"""
WITH r AS (SELECT event_type AS s, event_id AS o,
                  (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // {BATCH_SIZE} AS b FROM events),
     g AS (SELECT s, b, count(*) AS n, min(o) AS lo, max(o) AS hi FROM r GROUP BY s, b),
     k AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN n = {BATCH_SIZE} THEN 0 ELSE 1 END,
                                                 CASE WHEN n = {BATCH_SIZE} THEN hi ELSE lo END, s, b) AS batch_no FROM g)"""


def _plan(spark, sf_dir):
    env = with_source(fx.events_envelope(spark, sf_dir))
    rows, ordered = B.plan_batches(env, BATCH_SIZE)
    return env, rows, ordered


@register("batch_plan", _BATCHES_SQL + """
SELECT s AS _source_id, b AS batch_seq, n AS n_rows, lo AS min_offset, hi AS max_offset FROM g""")
def batch_plan(spark, sf_dir):
    env = with_source(fx.events_envelope(spark, sf_dir))
    rows = B.assign_batches(env, BATCH_SIZE)
    return B.batch_table(rows, BATCH_SIZE).select(SOURCE_COL, "batch_seq", "n_rows", "min_offset", "max_offset")


@register("batch_order", _BATCHES_SQL + """
SELECT s AS _source_id, b AS batch_seq, n AS n_rows, lo AS min_offset, hi AS max_offset,
       n = 100 AS is_full, batch_no FROM k""".replace("100", str(BATCH_SIZE)))
def batch_order(spark, sf_dir):
    _env, _rows, ordered = _plan(spark, sf_dir)
    return ordered.select(SOURCE_COL, "batch_seq", "n_rows", "min_offset", "max_offset", "is_full", "batch_no")


@register("flush_plan_batches", _BATCHES_SQL + f"""
SELECT (batch_no - 1) // {FLUSH_EVERY} AS flush_no, count(*) AS n_batches, count(DISTINCT s) AS n_files,
       CAST(sum(n) AS BIGINT) AS n_rows FROM k GROUP BY 1""")
def flush_plan_batches(spark, sf_dir):
    _env, _rows, ordered = _plan(spark, sf_dir)
    return B.flush_by_batches(ordered, FLUSH_EVERY)


@register("flush_files", _BATCHES_SQL + f"""
SELECT (batch_no - 1) // {FLUSH_EVERY} AS flush_no, s AS _source_id, CAST(sum(n) AS BIGINT) AS n_rows
FROM k GROUP BY 1, 2""")
def flush_files(spark, sf_dir):
    """The planned flushes are landed; the rows are counted in the files of each flush and source.

    Their files grow with the events (one for each flush and source), so they are read back and counted a group of flushes at a time.
    """
    env = with_source(fx.events_envelope(spark, sf_dir))
    opts = LandOptions(base=scratch_path(spark, "flush_files"))
    landed = land(B.plan_flushes(env, BATCH_SIZE, FLUSH_EVERY), opts, batch_col="flush_no", flush_ts=F.col("arrival_ts"))
    flush = F.substring_index("_batch_id", "-", -1).cast("long")
    counts = scratch_path(spark, "flush_files_counts")
    spark.createDataFrame([], FLUSH_FILES).write.parquet(counts)
    for batches in batch_groups(landed):
        back = read_dataset(spark, opts.base, include_internal=True, batches=batches)
        (back.select(flush.alias("flush_no"), SOURCE_COL).coalesce(fs.FEW_TASKS).groupBy("flush_no", SOURCE_COL)
         .agg(F.count(F.lit(1)).alias("n_rows")).write.mode("append").parquet(counts))
    return spark.read.schema(FLUSH_FILES).parquet(counts)


@register("flush_plan_time", f"""
SELECT time_bucket(INTERVAL {FLUSH_SECONDS} SECOND, ts) AS flush_start, count(*) AS n_rows,
       count(DISTINCT event_type) AS n_files, min(event_id) AS min_offset, max(event_id) AS max_offset
FROM events GROUP BY 1""")
def flush_plan_time(spark, sf_dir):
    env = with_source(fx.events_envelope(spark, sf_dir))
    return B.flush_by_time(env, FLUSH_SECONDS)


@register("max_batches", _BATCHES_SQL + f"""
SELECT r.o AS "offset", r.s AS _source_id, k.batch_no FROM r JOIN k ON r.s = k.s AND r.b = k.b
WHERE k.batch_no <= {MAX_BATCHES}""")
def max_batches(spark, sf_dir):
    _env, rows, ordered = _plan(spark, sf_dir)
    return B.limit_batches(rows, ordered, MAX_BATCHES).select("offset", SOURCE_COL, "batch_no")


@register("metrics_by_source", _BATCHES_SQL + """
SELECT 'kafka' AS kind, 'local' AS sink, s AS _source_id, count(*) AS n_batches, CAST(sum(n) AS BIGINT) AS n_records
FROM k GROUP BY s""")
def metrics_by_source_q(spark, sf_dir):
    env, _rows, ordered = _plan(spark, sf_dir)
    kinds = env.select(SOURCE_COL, "kind").distinct()  # one row per (source, kind)
    return metrics_by_source(ordered, kinds, "local")


@register("schema_drift_union", """
SELECT event_id, ts, CAST(user_id AS VARCHAR) AS user_id, event_type, "value", NULL AS extra
FROM events WHERE event_type IN ('click', 'error')
UNION ALL
SELECT event_id, ts, CAST(user_id AS VARCHAR), event_type, "value", 'x' || CAST(event_id AS VARCHAR)
FROM events WHERE event_type IN ('purchase', 'signup')
UNION ALL
SELECT event_id, ts, CAST(user_id AS VARCHAR), event_type, "value", NULL FROM events WHERE event_type = 'view'""")
def schema_drift_union(spark, sf_dir):
    return union_widened(fx.drift_parts(spark, sf_dir))


# ---- period keys and merge planning over a flush-file listing ----------------------------------

_LISTING = r"""
WITH l AS (
  SELECT event_type AS dir, 'data_' || strftime(ts, '%Y%m%d_%H%M%S') || '_' || printf('%06d', event_id) || '.parquet' AS name
  FROM events
  UNION ALL SELECT * FROM (VALUES ('click', 'merged_20240101.parquet'), ('click', 'part-0.parquet'),
                                  ('click', 'data_x.parquet')) v(dir, name)),
p AS (SELECT dir, name, CASE WHEN regexp_matches(name, '^data_[0-9]{8}_[0-9]{6}_.*\.parquet$')
                             THEN try_strptime(substr(name, 6, 15), '%Y%m%d_%H%M%S') END AS t FROM l)"""

_LISTING_YEAR_ENDS = _LISTING.replace(
    "strftime(ts, '%Y%m%d_%H%M%S')",
    f"strftime(DATE '2020-01-01' + CAST(event_id % {fx.YEAR_END_DAYS} AS INTEGER), '%Y%m%d') || '_' || strftime(ts, '%H%M%S')")

_KEY_SQL = {
    "hour": "strftime(t, '%Y%m%d_%H')",
    "day": "strftime(t, '%Y%m%d')",
    "month": "strftime(t, '%Y%m')",
    "week": "strftime(t, '%G') || 'W' || strftime(t, '%V')",
    "week_calendar": "CAST(year(t) AS VARCHAR) || 'W' || strftime(t, '%V')",
    "default": "strftime(t, '%Y%m%d')",
}


def _period_query(period: str, week_year: str, year_ends: bool):
    def q(spark, sf_dir):
        listing = fx.flush_listing(spark, sf_dir, year_ends=year_ends)
        return CP.with_period(listing, period, week_year).select("dir", "name", "period_key")
    return q


for _key, _period, _wy, _ye in [("hour", "hour", "iso", False), ("day", "day", "iso", False),
                                ("month", "month", "iso", True), ("week", "week", "iso", True),
                                ("week_calendar", "week", "calendar", True), ("default", "quarter", "iso", False)]:
    register(f"period_key_{_key}", (_LISTING_YEAR_ENDS if _ye else _LISTING)
             + f"\nSELECT dir, name, {_KEY_SQL[_key]} AS period_key FROM p")(_period_query(_period, _wy, _ye))


@register("period_key_malformed", _LISTING + """
SELECT dir, count(t) AS n_ok, count(*) - count(t) AS n_malformed FROM p GROUP BY dir""")
def period_key_malformed(spark, sf_dir):
    return CP.name_status(fx.flush_listing(spark, sf_dir))


@register("merge_candidates", _LISTING + """
SELECT dir, name FROM l WHERE starts_with(name, 'data_') AND ends_with(name, '.parquet')""")
def merge_candidates(spark, sf_dir):
    return CP.candidates(fx.flush_listing(spark, sf_dir)).select("dir", "name")


@register("merge_plan", _LISTING + """
SELECT dir, strftime(t, '%Y%m%d_%H') AS period_key, count(*) AS n_files FROM p WHERE t IS NOT NULL
GROUP BY 1, 2 HAVING count(*) >= 2""")
def merge_plan(spark, sf_dir):
    return CP.merge_plan(fx.flush_listing(spark, sf_dir), "hour", 2)


@register("file_name_format", """
SELECT event_id AS "offset", 'data_' || strftime(ts, '%Y%m%d_%H%M%S') || '_' || printf('%06d', event_id) || '.parquet' AS name
FROM events""")
def file_name_format(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("offset"), flush_file_name(F.col("ts"), F.col("event_id")).alias("name"))


REDIS_BATCH = 1000


@register("redis_batch_budget", f"""
WITH r AS (SELECT 'stream:' || event_type AS k,
                  (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // {REDIS_BATCH} AS rnd FROM events)
SELECT rnd AS round, count(*) AS n_streamed, count(DISTINCT k) AS n_streams,
       CAST(greatest({REDIS_BATCH} - count(*), 0) AS BIGINT) AS list_budget
FROM r GROUP BY rnd""")
def redis_batch_budget(spark, sf_dir):
    from siltbed.sources.envelope import from_redis

    env = with_source(from_redis(fx.redis_frame(spark, sf_dir)))
    return B.redis_read_rounds(env, REDIS_BATCH)
