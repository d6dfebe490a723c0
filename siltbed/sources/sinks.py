"""Sink locations: local, S3 (S3A) and HDFS base URIs and the Hadoop settings they need.

Every sink uses the same Parquet writer; only the base URI and a few file-system settings
differ. Credentials are passed through Hadoop configuration, never embedded in paths.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import urlparse

SINK_TYPES = ("local", "s3", "hdfs")
NEEDED = {"local": ["base_path"], "s3": ["bucket"], "hdfs": ["url", "base_path"]}


@dataclass
class SinkOptions:
    type: str
    base_path: str | None = None      # local: folder; hdfs: path on the cluster
    bucket: str | None = None         # s3
    prefix: str = ""                  # s3
    url: str | None = None            # hdfs name node, e.g. hdfs://nn:8020
    endpoint_url: str | None = None   # s3-compatible stores
    region_name: str | None = None
    access_key: str | None = None
    secret_key: str | None = None
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.type not in SINK_TYPES:
            raise ValueError(f"unsupported sink type {self.type!r}; expected one of {SINK_TYPES}")
        for name in NEEDED[self.type]:
            if not getattr(self, name):
                raise ValueError(f"option {name!r} of a {self.type} sink is not set")


def base_uri(o: SinkOptions) -> str:
    if o.type == "local":
        p = o.base_path
        return p if urlparse(p).scheme else f"file://{p if p.startswith('/') else '/' + p}"
    if o.type == "s3":
        prefix = o.prefix.strip("/")
        return f"s3a://{o.bucket}/{prefix}" if prefix else f"s3a://{o.bucket}"
    u = urlparse(o.url)
    host = u.netloc or u.path
    return f"hdfs://{host}/{o.base_path.lstrip('/')}"


def hadoop_conf(o: SinkOptions) -> dict[str, str]:
    """Settings to apply with ``spark.conf``/``spark.hadoop.*`` before writing to this sink."""
    conf: dict[str, str] = {}
    if o.type == "s3":
        if o.endpoint_url:
            plain = o.endpoint_url.lower().startswith("http://")  # a bare host:port is secure
            conf["spark.hadoop.fs.s3a.endpoint"] = o.endpoint_url.split("://", 1)[-1].rstrip("/")
            conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(not plain).lower()
            conf["spark.hadoop.fs.s3a.path.style.access"] = "true"
        if o.region_name:
            conf["spark.hadoop.fs.s3a.endpoint.region"] = o.region_name
        if o.access_key and o.secret_key:
            conf["spark.hadoop.fs.s3a.access.key"] = o.access_key
            conf["spark.hadoop.fs.s3a.secret.key"] = o.secret_key
    conf.update({f"spark.hadoop.{k}" if not k.startswith("spark.") else k: str(v) for k, v in o.extra.items()})
    return conf


def apply_conf(spark, o: SinkOptions) -> None:
    """Make the sink's settings known to a running session: to its readers and writers and to our own file-system calls."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for k, v in hadoop_conf(o).items():
        if k.startswith("spark.hadoop."):
            hadoop.set(k[len("spark.hadoop."):], v)
        else:
            spark.conf.set(k, v)
