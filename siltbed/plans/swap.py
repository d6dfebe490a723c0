"""Put files into place, and take others away, so that a crash at any point is made good by the next job.

A job writes its files below ``<folder>/_swap-<id>/rows``, then a journal ``_swap-<id>/journal`` that names every new file's place and
every file that goes. Once the journal is complete the swap is decided: :func:`finish` moves and deletes, and may be repeated from any
point. A job that died before leaves a hidden folder only, which the next one removes. The journal is written by Spark and read
a partition at a time; moves and deletes are metadata calls, many at a time (``THREADS``).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.plans import fs

JOURNAL = "kind string, path string, target string"
PREFIXES = ("_swap-", "_merge-")  # the second is an older name
THREADS = 16


def new_job(folder: str) -> str:
    return f"{folder.rstrip('/')}/{PREFIXES[0]}{uuid.uuid4().hex}"


def written(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of the Parquet files below ``root``."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .load(root).select("path", "length"))


def folder_value(path: str | Column, name: str) -> Column:
    """Value of the partition folder ``<name>=<value>`` in a path; null where the folder stands for null."""
    raw = F.regexp_extract(path, rf"/{name}=([^/]*)/", 1)
    return F.when(raw != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))))


def decide(job: str, new: DataFrame, old: DataFrame | None = None) -> None:
    """Write the journal. new: (path, target); old: (path) of the files that go."""
    steps = new.select(F.lit("new").alias("kind"), "path", "target")
    if old is not None:
        steps = steps.unionByName(old.select(F.lit("old").alias("kind"), "path", F.lit(None).cast("string").alias("target")))
    steps.write.json(f"{job}/journal")


def finish(spark: SparkSession, folder: str) -> None:
    """Carry through the swaps whose journal is complete, and remove what others left."""
    for name in fs.list_dirs(spark, folder):
        if not name.startswith(PREFIXES):
            continue
        job = f"{folder}/{name}"
        if fs.exists(spark, f"{job}/journal/_SUCCESS"):
            steps = spark.read.schema(JOURNAL).json(f"{job}/journal")
            # every new file is in place before the first old one goes
            _each(steps.where("kind = 'new'"), lambda s: fs.exists(spark, s.path) and fs.move(spark, s.path, s.target))
            _each(steps.where("kind = 'old'"), lambda s: fs.delete(spark, s.path))
        fs.delete(spark, job)


def _each(steps: DataFrame, act) -> None:
    rows = steps.toLocalIterator()
    with ThreadPoolExecutor(THREADS) as pool:
        while part := list(islice(rows, 1000)):
            list(pool.map(act, part))
