"""One way to open any source by its type; an unknown type is refused before anything starts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltbed.sources.envelope import ENVELOPE, from_redis
from siltbed.sources.kafka import KafkaSourceOptions, read_kafka

SOURCE_TYPES = ("kafka", "redis", "files")


def open_source(spark: SparkSession, kind: str, options: dict, streaming: bool = True) -> DataFrame:
    """The source's messages as an envelope; ``options``: those of its type.

    files: ``path`` of envelope rows stored as Parquet, and options of Spark's file stream (maxFilesPerTrigger).
    """
    if kind not in SOURCE_TYPES:
        raise ValueError(f"unsupported source type {kind!r}; expected one of {SOURCE_TYPES}")
    if kind == "kafka":
        return read_kafka(spark, KafkaSourceOptions(**options), streaming)
    if kind == "redis":
        from siltbed.sources import redis

        redis.register(spark)
        reader = spark.readStream if streaming else spark.read
        return from_redis(reader.format("siltbed_redis").options(**options).load())
    path = options.get("path")
    if not path:
        raise ValueError("no path given to read files from")
    reader = spark.readStream if streaming else spark.read
    return reader.schema(ENVELOPE).options(**{k: v for k, v in options.items() if k != "path"}).parquet(path)
