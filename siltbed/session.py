"""Session helpers: a local session for tests/bench and shared scratch locations.

On a cluster the scratch root is the shared folder the cluster names in
``spark.checkpoint.dir``; a machine-local temp folder is only used when that
setting is absent (local tests), and then it is registered as the checkpoint dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # local runs only: tiny test inputs would otherwise be coalesced into a single writer task
    # (per-file writer setup then dominates); on a cluster AQE's defaults size the partitions.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "siltbed", extra: dict | None = None) -> SparkSession:
    """Local session with the settings the library assumes (UTC, AQE, no UI)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local one is made only when unset.

    The same folder is registered as the SparkContext checkpoint dir (Spark adds a per-app
    subfolder under it), so ``DataFrame.checkpoint`` and our scratch outputs share one root.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="siltbed-ckpt-")  # local runs only (tests)
        spark.conf.set("spark.checkpoint.dir", configured)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh folder under the shared checkpoint dir for job outputs (lineage cuts, demos)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "/".join(p.strip("/") for p in parts if p)
    if unique:
        leaf = f"{leaf}-{uuid.uuid4().hex[:12]}" if leaf else uuid.uuid4().hex[:12]
    return f"{root}/siltbed/{leaf}"


def cut_lineage(df):
    """Reliable checkpoint into spark.checkpoint.dir (never localCheckpoint: executors may be lost)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
