"""Connector options: Kafka option map, trigger choice, sink URIs and required settings."""

import pytest

from siltbed.sources.kafka import DEFAULT_GROUP_ID, KafkaSourceOptions, kafka_options, trigger_for
from siltbed.sources.sinks import SinkOptions, base_uri, hadoop_conf


def test_kafka_defaults_and_subscribe():
    o = KafkaSourceOptions(bootstrap_servers=["b1:9092", "b2:9092"], topics=["a", "b"])
    m = kafka_options(o)
    assert m["kafka.bootstrap.servers"] == "b1:9092,b2:9092"
    assert m["subscribe"] == "a,b"
    assert m["startingOffsets"] == "earliest"
    assert m["kafka.group.id"] == DEFAULT_GROUP_ID
    assert "maxOffsetsPerTrigger" not in m and "minOffsetsPerTrigger" not in m
    assert trigger_for(o) == {"processingTime": "0 seconds"}  # runs on until it is stopped
    assert trigger_for(KafkaSourceOptions(["b:1"], ["t"], once=True)) == {"availableNow": True}


def test_kafka_client_config_passes_through_and_wins():
    o = KafkaSourceOptions(["b:1"], ["t"], consumer_config={"security.protocol": "SSL", "enable.auto.commit": False,
                                                           "group.id": "mine"})
    m = kafka_options(o)
    assert m["kafka.security.protocol"] == "SSL"
    assert m["kafka.group.id"] == "mine"
    assert "kafka.enable.auto.commit" not in m


def test_kafka_flush_by_count_or_time():
    o = KafkaSourceOptions(["b:1"], ["t"], batch_size=5000, flush_interval_batches=100, flush_interval_seconds=300)
    m = kafka_options(o)
    assert m["minOffsetsPerTrigger"] == "500000" and m["maxTriggerDelay"] == "300s" and "maxOffsetsPerTrigger" not in m
    assert trigger_for(o) == {"processingTime": "0 seconds"}  # whichever comes first, not the next tick
    timed = KafkaSourceOptions(["b:1"], ["t"], flush_interval_seconds=300)
    assert trigger_for(timed) == {"processingTime": "300 seconds"}
    assert not any("OffsetsPerTrigger" in k for k in kafka_options(timed))  # a tick takes all that arrived
    counted = kafka_options(KafkaSourceOptions(["b:1"], ["t"], flush_interval_batches=3))
    assert counted["minOffsetsPerTrigger"] == "3000" and "maxTriggerDelay" not in counted
    capped = kafka_options(KafkaSourceOptions(["b:1"], ["t"], max_records_per_flush=7))
    assert capped["maxOffsetsPerTrigger"] == "7"


def test_kafka_callers_offset_reset_wins():
    o = KafkaSourceOptions(["b:1"], ["t"], consumer_config={"auto.offset.reset": "latest"})
    assert kafka_options(o)["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka_options(KafkaSourceOptions(["b:1"], ["t"], consumer_config={"auto.offset.reset": "middle"}))


@pytest.mark.parametrize("kw", [dict(bootstrap_servers=[], topics=["t"]), dict(bootstrap_servers=["b"], topics=[]),
                                dict(bootstrap_servers=["b"], topics=["t"], value_format="xml"),
                                dict(bootstrap_servers=["b"], topics=["t"], auto_offset_reset="middle")])
def test_kafka_refuses_bad_options(kw):
    with pytest.raises(ValueError):
        KafkaSourceOptions(**kw)


def test_sink_uris():
    assert base_uri(SinkOptions("local", base_path="/data/lake")) == "file:///data/lake"
    assert base_uri(SinkOptions("s3", bucket="bk", prefix="raw/events/")) == "s3a://bk/raw/events"
    assert base_uri(SinkOptions("hdfs", url="hdfs://nn:8020", base_path="/lake")) == "hdfs://nn:8020/lake"
    conf = hadoop_conf(SinkOptions("s3", bucket="bk", endpoint_url="http://minio:9000"))
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "minio:9000"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    bare = hadoop_conf(SinkOptions("s3", bucket="bk", endpoint_url="store.example.com:9000"))
    assert bare["spark.hadoop.fs.s3a.endpoint"] == "store.example.com:9000"
    assert bare["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"


@pytest.mark.parametrize("kw", [dict(type="s3"), dict(type="hdfs", url="hdfs://nn"), dict(type="local"),
                                dict(type="ftp", base_path="/x")])
def test_sink_required_options(kw):
    with pytest.raises(ValueError):
        SinkOptions(**kw)
