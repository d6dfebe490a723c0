"""Envelope stand-ins built by Spark from the driver's tables (no made-up input).

``events`` becomes a Kafka-shaped envelope: topic = event_type, offset = event_id,
arrival_ts = ts (UTC), value = JSON of (event_id, ts, user_id, value, props) with
microsecond timestamps. Variants exercise tag precedence, poison messages, Redis
fields, schema drift and mixed sources. Every variant covers the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.sources.envelope import TS_NTZ_MICROS, from_table

PAYLOAD = ["event_id", "ts", "user_id", "value", "props"]
EVENT_SCHEMA_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, value DOUBLE, props STRING"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return from_table(ev, kind="kafka", topic=F.col("event_type"), offset=F.col("event_id"),
                      arrival_ts=F.col("ts"), payload=PAYLOAD)


def kafka_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the Kafka source's own column layout."""
    ev = table(spark, sf_dir, "events")
    value = F.to_json(F.struct(*PAYLOAD), {"timestampNTZFormat": TS_NTZ_MICROS}).cast("binary")
    return ev.select(F.col("user_id").cast("string").cast("binary").alias("key"), value.alias("value"),
                     F.col("event_type").alias("topic"), F.lit(0).alias("partition"),
                     F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
                     F.lit(0).alias("timestampType"))


def precedence_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 3rd message lost its topic (null or ''); all carry a stream key ``stream:<type>``."""
    env = events_envelope(spark, sf_dir)
    topic = (F.when(F.col("offset") % 6 == 0, F.lit(None).cast("string"))
             .when(F.col("offset") % 6 == 3, F.lit("")).otherwise(F.col("topic")))
    return env.withColumn("stream_key", F.concat(F.lit("stream:"), F.col("topic"))).withColumn("topic", topic)


def poison_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'not json' where offset % 97 = 0, '5' where % 89 = 0, NULL where % 83 = 0 (first match wins)."""
    env = events_envelope(spark, sf_dir)
    o = F.col("offset")
    value = (F.when(o % 97 == 0, F.lit("not json").cast("binary"))
             .when(o % 89 == 0, F.lit("5").cast("binary"))
             .when(o % 83 == 0, F.lit(None).cast("binary"))
             .otherwise(F.col("value")))
    return env.withColumn("value", value)


def tombstone_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka tombstones: NULL value where offset % 83 = 0."""
    env = events_envelope(spark, sf_dir)
    return env.withColumn("value", F.when(F.col("offset") % 83 == 0, F.lit(None).cast("binary"))
                          .otherwise(F.col("value")))


def redis_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redis stream entries of ``events``: fields map; ``value`` absent on every 10th entry."""
    ev = table(spark, sf_dir, "events")
    value = F.to_json(F.struct(*PAYLOAD), {"timestampNTZFormat": TS_NTZ_MICROS}).cast("binary")
    src = F.lit("producer").cast("binary")
    fields = F.when(F.col("event_id") % 10 == 9, F.create_map(F.lit("source"), src)).otherwise(
        F.create_map(F.lit("value"), value, F.lit("source"), src))
    return ev.select(F.lit("redis_stream").alias("kind"), F.concat(F.lit("stream:"), F.col("event_type")).alias("key"),
                     F.col("event_id").alias("entry_seq"), F.col("ts").cast("timestamp").alias("arrival_ts"),
                     fields.alias("fields"))


def mixed_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka topics from ``events``, a Redis stream from ``conversations``, Redis lists from ``documents``."""
    ev = events_envelope(spark, sf_dir)
    conv = table(spark, sf_dir, "conversations")
    conv_env = from_table(conv, kind="redis_stream", stream_key=F.lit("conversations"),
                          offset=F.col("conv_id") * 1000 + F.col("turn"),
                          arrival_ts=F.lit("2024-01-01 00:00:00").cast("timestamp"),
                          payload=["conv_id", "turn", "role", "text"])
    docs = table(spark, sf_dir, "documents")
    doc_env = from_table(docs, kind="redis_list", stream_key=F.concat(F.lit("documents:"), F.col("lang")),
                         offset=F.col("doc_id"), arrival_ts=F.lit("2024-01-01 00:00:00").cast("timestamp"),
                         payload=["doc_id", "lang", "source", "n_chars", "text"])
    return ev.unionByName(conv_env).unionByName(doc_env)


def drift_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three batches of ``events`` split by type: A plain, B with ``extra``, C with user_id as string."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    a = ev.where(F.col("event_type").isin("click", "error"))
    b = ev.where(F.col("event_type").isin("purchase", "signup")).withColumn(
        "extra", F.concat(F.lit("x"), F.col("event_id").cast("string")))
    c = ev.where(F.col("event_type") == "view").withColumn("user_id", F.col("user_id").cast("string"))
    return [a, b, c]


# Names in a listing that are not flush files.
NON_FLUSH_NAMES = [("click", "merged_20240101.parquet"), ("click", "part-0.parquet"), ("click", "data_x.parquet")]
YEAR_END_DAYS = 2202  # 2020-01-01 .. 2026-01-10


def flush_listing(spark: SparkSession, sf_dir: str, year_ends: bool = False, extras: bool = True) -> DataFrame:
    """One flush-file name per event (folder = event type), plus names that are not flush files.

    ``year_ends`` spreads the names over 2020-01-01 .. 2026-01-10 to cross year boundaries.
    """
    from siltbed.functions.names import flush_file_name

    ev = table(spark, sf_dir, "events")
    if year_ends:
        day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("event_id") % YEAR_END_DAYS).cast("int"))
        name = F.concat(F.lit("data_"), F.date_format(day, "yyyyMMdd"), F.lit("_"), F.date_format("ts", "HHmmss"),
                        F.lit("_"), F.format_string("%06d", F.col("event_id")), F.lit(".parquet"))
    else:
        name = flush_file_name(F.col("ts"), F.col("event_id"))
    out = ev.select(F.col("event_type").alias("dir"), name.alias("name"))
    if extras:
        out = out.unionByName(spark.createDataFrame(NON_FLUSH_NAMES, "dir string, name string"))
    return out
