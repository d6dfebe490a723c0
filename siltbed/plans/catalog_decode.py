"""Registered queries: sources, tagging, decode, quarantine, policy (S1 S6 S8 D1-D4 D7-D9 A3 A4)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.timeparts import with_time_partitions
from siltbed.operators.decode import decode_json, decode_json_inferred
from siltbed.operators.metrics import errors_by_reason
from siltbed.plans import fixtures as fx
from siltbed.plans.registry import register
from siltbed.sources.envelope import SOURCE_COL, from_kafka, from_redis, with_source

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType())])


@register("kafka_envelope", """
SELECT 'kafka' AS kind, event_type AS topic, CAST(NULL AS VARCHAR) AS stream_key, CAST(0 AS INTEGER) AS "partition",
       event_id AS "offset", ts AS arrival_ts, event_id AS payload_event_id
FROM events""")
def kafka_envelope(spark, sf_dir):
    env = from_kafka(fx.kafka_frame(spark, sf_dir))
    return env.select("kind", "topic", "stream_key", "partition", "offset",
                      F.col("arrival_ts").cast("timestamp_ntz").alias("arrival_ts"),
                      F.get_json_object(F.col("value").cast("string"), "$.event_id").cast("long")
                      .alias("payload_event_id"))


@register("redis_value_field", """
SELECT 'stream:' || event_type AS _source_id, count(*) AS n_messages,
       CAST(sum(CASE WHEN event_id % 10 = 9 THEN 0 ELSE 1 END) AS BIGINT) AS n_good,
       CAST(sum(CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END) AS BIGINT) AS n_missing_value
FROM events GROUP BY 1""")
def redis_value_field(spark, sf_dir):
    env = with_source(from_redis(fx.redis_frame(spark, sf_dir)))
    d = decode_json(env, EVENT_SCHEMA)
    good = d.good.groupBy(SOURCE_COL).agg(F.count(F.lit(1)).alias("n_good"))
    bad = d.quarantine.where(F.col("reason") == "null_value").groupBy(SOURCE_COL).agg(
        F.count(F.lit(1)).alias("n_missing_value"))
    tot = env.groupBy(SOURCE_COL).agg(F.count(F.lit(1)).alias("n_messages"))
    return (tot.join(good, SOURCE_COL, "left").join(bad, SOURCE_COL, "left")
            .select(SOURCE_COL, "n_messages", F.coalesce("n_good", F.lit(0)).alias("n_good"),
                    F.coalesce("n_missing_value", F.lit(0)).alias("n_missing_value")))


@register("mixed_sources", """
SELECT 'kafka' AS kind, event_type AS _source_id, count(*) AS n_messages, min(event_id) AS min_offset, max(event_id) AS max_offset
FROM events GROUP BY 1, 2
UNION ALL
SELECT 'redis_stream', 'conversations', count(*), min(conv_id * 1000 + turn), max(conv_id * 1000 + turn) FROM conversations
UNION ALL
SELECT 'redis_list', 'documents:' || lang, count(*), min(doc_id), max(doc_id) FROM documents GROUP BY 1, 2""")
def mixed_sources(spark, sf_dir):
    env = with_source(fx.mixed_envelope(spark, sf_dir))
    return env.groupBy("kind", SOURCE_COL).agg(F.count(F.lit(1)).alias("n_messages"),
                                               F.min("offset").alias("min_offset"),
                                               F.max("offset").alias("max_offset"))


@register("source_tag", """SELECT event_id AS "offset", event_type AS _source_id FROM events""")
def source_tag(spark, sf_dir):
    return with_source(fx.events_envelope(spark, sf_dir)).select("offset", SOURCE_COL)


@register("source_precedence", """
SELECT event_id AS "offset",
       CASE WHEN event_id % 6 IN (0, 3) THEN 'stream:' || event_type ELSE event_type END AS _source_id
FROM events""")
def source_precedence(spark, sf_dir):
    return with_source(fx.precedence_envelope(spark, sf_dir)).select("offset", SOURCE_COL)


@register("time_partitions", """
SELECT event_id AS "offset", strftime(ts, '%Y-%m-%d') AS "date", CAST(hour(ts) AS INTEGER) AS "hour" FROM events""")
def time_partitions(spark, sf_dir):
    good = decode_json(with_source(fx.events_envelope(spark, sf_dir)), EVENT_SCHEMA).good
    return with_time_partitions(good, "ts").select("offset", "date", "hour")


@register("json_decode_declared", """
SELECT event_type AS _source_id, event_id AS "offset", event_id, ts, user_id, "value", props FROM events""")
def json_decode_declared(spark, sf_dir):
    good = decode_json(with_source(fx.events_envelope(spark, sf_dir)), EVENT_SCHEMA).good
    return good.select(SOURCE_COL, "offset", "event_id", "ts", "user_id", "value", "props")


@register("json_decode_inferred", """
SELECT event_type AS _source_id, event_id AS "offset", event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts,
       user_id, "value", props FROM events""")
def json_decode_inferred(spark, sf_dir):
    decoded, _schema = decode_json_inferred(with_source(fx.events_envelope(spark, sf_dir)))
    return decoded.good.select(SOURCE_COL, "offset", "event_id", "ts", "user_id", "value", "props")


_POISON_CASE = """CASE WHEN event_id % 97 = 0 THEN 'malformed' WHEN event_id % 89 = 0 THEN 'not_object'
                      WHEN event_id % 83 = 0 THEN 'null_value' END"""
_POISON_TEXT = """CASE WHEN event_id % 97 = 0 THEN 'not json' WHEN event_id % 89 = 0 THEN '5' END"""


@register("quarantine_poison", f"""
SELECT event_type AS _source_id, event_id AS "offset", {_POISON_CASE} AS reason, {_POISON_TEXT} AS value_text
FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0""")
def quarantine_poison(spark, sf_dir):
    q = decode_json(with_source(fx.poison_envelope(spark, sf_dir)), EVENT_SCHEMA).quarantine
    return q.select(SOURCE_COL, "offset", "reason", F.col("value").cast("string").alias("value_text"))


@register("quarantine_null", """
SELECT event_type AS _source_id, CAST(sum(CASE WHEN event_id % 83 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS n_good,
       CAST(sum(CASE WHEN event_id % 83 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_null
FROM events GROUP BY 1""")
def quarantine_null(spark, sf_dir):
    d = decode_json(with_source(fx.tombstone_envelope(spark, sf_dir)), EVENT_SCHEMA)
    return _good_bad_counts(d, "n_good", "n_null")


@register("errors_by_reason", f"""
SELECT event_type AS _source_id, {_POISON_CASE} AS reason, count(*) AS n_errors
FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0 GROUP BY 1, 2""")
def errors_by_reason_q(spark, sf_dir):
    q = decode_json(with_source(fx.poison_envelope(spark, sf_dir)), EVENT_SCHEMA).quarantine
    return errors_by_reason(q)


def _good_bad_counts(d, good_name, bad_name):
    g = d.good.select(SOURCE_COL, F.lit(1).alias("_g"), F.lit(0).alias("_b"))
    b = d.quarantine.select(SOURCE_COL, F.lit(0).alias("_g"), F.lit(1).alias("_b"))
    return (g.unionByName(b).groupBy(SOURCE_COL)
            .agg(F.sum("_g").cast("long").alias(good_name), F.sum("_b").cast("long").alias(bad_name)))


@register("policy_log", """
SELECT event_type AS _source_id,
       CAST(sum(CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS n_good,
       CAST(sum(CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_quarantined
FROM events GROUP BY 1""")
def policy_log(spark, sf_dir):
    d = decode_json(with_source(fx.poison_envelope(spark, sf_dir)), EVENT_SCHEMA, policy="log")
    return _good_bad_counts(d, "n_good", "n_quarantined")


@register("policy_ignore", """
SELECT event_type AS _source_id,
       CAST(sum(CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS n_good,
       CAST(0 AS BIGINT) AS n_quarantined
FROM events GROUP BY 1""")
def policy_ignore(spark, sf_dir):
    d = decode_json(with_source(fx.poison_envelope(spark, sf_dir)), EVENT_SCHEMA, policy="ignore")
    return _good_bad_counts(d, "n_good", "n_quarantined")
