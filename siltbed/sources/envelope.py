"""The message envelope: one row per message, whatever transport carried it.

``kind string, topic string, stream_key string, partition int, offset long,
arrival_ts timestamp, value binary``. The offset is kept so that batching and
replay are deterministic. Connectors only project their native frame to this shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_COL = "_source_id"

ENVELOPE = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("stream_key", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("arrival_ts", T.TimestampType()),
    T.StructField("value", T.BinaryType()),
])

ENVELOPE_COLS = [f.name for f in ENVELOPE.fields]

# Fixed value: microsecond timestamps in JSON payloads (to_json would cut to milliseconds).
TS_NTZ_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _project(kind: Column, topic: Column, stream_key: Column, partition: Column,
             offset: Column, arrival_ts: Column, value: Column) -> list[Column]:
    return [
        kind.cast("string").alias("kind"),
        topic.cast("string").alias("topic"),
        stream_key.cast("string").alias("stream_key"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        arrival_ts.cast("timestamp").alias("arrival_ts"),
        value.cast("binary").alias("value"),
    ]


def from_kafka(df: DataFrame) -> DataFrame:
    """Kafka source frame (key, value, topic, partition, offset, timestamp, ...) -> envelope."""
    return df.select(*_project(F.lit("kafka"), F.col("topic"), F.lit(None), F.col("partition"),
                               F.col("offset"), F.col("timestamp"), F.col("value")))


def from_redis(df: DataFrame, value_field: str = "value") -> DataFrame:
    """Redis reader frame (kind, key, entry_seq, arrival_ts, fields map<string,binary>) -> envelope.

    Only the ``value`` field of an entry is the message; an entry without it keeps a
    null value and is quarantined downstream instead of vanishing.
    """
    return df.select(*_project(F.col("kind"), F.lit(None), F.col("key"), F.lit(0),
                               F.col("entry_seq"), F.col("arrival_ts"),
                               F.col("fields").getItem(value_field)))


def from_table(df: DataFrame, *, kind: str = "kafka", topic: Column | None = None,
               stream_key: Column | None = None, offset: Column, arrival_ts: Column,
               payload: list[str] | None = None, partition: Column | None = None,
               json_options: dict | None = None) -> DataFrame:
    """Any table -> envelope; the payload columns become a JSON value (the file stand-in, S11).

    ``arrival_ts`` given as timestamp_ntz is read in the session zone, which must be UTC.
    """
    cols = payload or [c for c in df.columns]
    opts = {"timestampNTZFormat": TS_NTZ_MICROS, "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    opts.update(json_options or {})
    value = F.to_json(F.struct(*[F.col(c) for c in cols]), opts)
    return df.select(*_project(
        F.lit(kind), topic if topic is not None else F.lit(None),
        stream_key if stream_key is not None else F.lit(None),
        partition if partition is not None else F.lit(0),
        offset, arrival_ts.cast("timestamp"), value))


def source_id(topic: Column | str = "topic", stream_key: Column | str = "stream_key") -> Column:
    """Tag precedence: topic, else stream key, else none; an empty string counts as absent."""
    t = F.col(topic) if isinstance(topic, str) else topic
    k = F.col(stream_key) if isinstance(stream_key, str) else stream_key
    return F.coalesce(F.nullif(t, F.lit("")), F.nullif(k, F.lit("")))


def with_source(df: DataFrame) -> DataFrame:
    """Add the ``_source_id`` routing column to an envelope."""
    return df.withColumn(SOURCE_COL, source_id())
