"""Kafka source: option map for Spark's Kafka connector and the envelope projection.

The connector jar is not bundled here; ``read_kafka`` works wherever
``spark-sql-kafka`` is on the classpath. Offsets live in the query checkpoint, so the
consumer's own auto-commit has no role: delivery comes from checkpoint + idempotent landing.

One micro-batch is one flush. A count flush waits for ``batch_size`` records x ``flush_interval_batches``
(``minOffsetsPerTrigger``); with a time interval too, it takes place on whichever comes first
(``maxTriggerDelay``), under the default trigger, which looks again as soon as a batch is done. A time flush alone
takes all that has arrived on each tick. ``maxOffsetsPerTrigger`` is set only if the caller gives
``max_records_per_flush``. A run goes on until it is stopped; ``once`` drains what is there and ends.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from siltbed.operators.decode import check_format
from siltbed.sources.envelope import from_kafka

# Defaults of the source.
DEFAULT_GROUP_ID = "siltbed-group"
DEFAULT_BATCH_SIZE = 1000
OFFSET_RESETS = {"earliest": "earliest", "latest": "latest"}
# client settings the connector manages itself (passing them is an error in Spark)
MANAGED = {"enable.auto.commit", "auto.offset.reset", "key.deserializer", "value.deserializer",
           "interceptor.classes"}


@dataclass
class KafkaSourceOptions:
    bootstrap_servers: list[str]
    topics: list[str]
    group_id: str | None = None
    value_format: str = "json"
    auto_offset_reset: str = "earliest"
    consumer_config: dict = field(default_factory=dict)
    batch_size: int = DEFAULT_BATCH_SIZE
    flush_interval_batches: int | None = None
    flush_interval_seconds: int | None = None
    max_records_per_flush: int | None = None
    once: bool = False

    def __post_init__(self):
        for name in ("bootstrap_servers", "topics"):
            if not getattr(self, name):
                raise ValueError(f"no {name} given to read from Kafka")
        check_format(self.value_format)
        if self.auto_offset_reset not in OFFSET_RESETS:
            raise ValueError(f"auto_offset_reset must be one of {sorted(OFFSET_RESETS)}")
        if self.batch_size < 1:
            raise ValueError("batch_size must be >= 1")
        self.group_id = self.group_id or DEFAULT_GROUP_ID


def kafka_options(o: KafkaSourceOptions) -> dict[str, str]:
    """Option map for ``spark.readStream.format("kafka")``; the caller's client config wins."""
    opts = {
        "kafka.bootstrap.servers": ",".join(o.bootstrap_servers),
        "subscribe": ",".join(o.topics),
        "startingOffsets": OFFSET_RESETS[o.auto_offset_reset],
        "kafka.group.id": o.group_id,
        "failOnDataLoss": "true",
    }
    if o.flush_interval_batches and not o.once:
        opts["minOffsetsPerTrigger"] = str(o.batch_size * o.flush_interval_batches)
        if o.flush_interval_seconds:
            opts["maxTriggerDelay"] = f"{int(o.flush_interval_seconds)}s"
    if o.max_records_per_flush:
        opts["maxOffsetsPerTrigger"] = str(o.max_records_per_flush)
    for k, v in o.consumer_config.items():
        if k == "auto.offset.reset":  # the connector's name for it; the caller wins
            if v not in OFFSET_RESETS:
                raise ValueError(f"auto.offset.reset must be one of {sorted(OFFSET_RESETS)}")
            opts["startingOffsets"] = OFFSET_RESETS[v]
        if k in MANAGED:
            continue  # the connector refuses them: offsets live in the checkpoint
        opts[f"kafka.{k}"] = str(v)
    return opts


def trigger_for(o: KafkaSourceOptions) -> dict:
    """A tick for a time flush alone; the default trigger otherwise; ``once`` drains and stops."""
    if o.once:
        return {"availableNow": True}
    if o.flush_interval_seconds and not o.flush_interval_batches:
        return {"processingTime": f"{int(o.flush_interval_seconds)} seconds"}
    return {"processingTime": "0 seconds"}


def read_kafka(spark: SparkSession, o: KafkaSourceOptions, streaming: bool = True) -> DataFrame:
    """Kafka topics as an envelope stream (or a bounded frame with ``streaming=False``)."""
    reader = spark.readStream if streaming else spark.read
    opts = kafka_options(o)
    if not streaming:
        for k in ("maxOffsetsPerTrigger", "minOffsetsPerTrigger", "maxTriggerDelay"):
            opts.pop(k, None)
    return from_kafka(reader.format("kafka").options(**opts).load())
