"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.session import scratch_path

#: ASCII white space, as the contracts write it; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and read it back.

    It cuts the lineage like a reliable checkpoint, but as compressed Parquet, with file statistics
    for the planner; any executor can read it again after a loss.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings (dots as double underscores) that hold for the jobs run inside."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def private(name: str) -> str:
    """A column name that no input column has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def word_list(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def slices(batch, rows: int = 512):
    """An Arrow batch in pieces, so that a task holds the working arrays of a few rows only."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def range_buckets(df: DataFrame, key: str, rows_per_bucket: int = 20_000, most: int = 2_000) -> Column:
    """Bucket number of the numeric column ``key``, rising with it, of about ``rows_per_bucket`` rows each.

    The bounds are fixed once, as literals, from a quantile sketch; so every later use of the
    column sees the same buckets whatever partitions it runs in. There are at most ``most``
    buckets: beyond that they hold more rows. Nulls are in bucket -1.
    """
    n = df.select(F.count(key)).first()[0]
    cuts = min(most, n // rows_per_bucket)
    if not cuts:
        return F.when(F.col(key).isNull(), -1).otherwise(0)
    marks = [i / (cuts + 1) for i in range(1, cuts + 1)]
    bounds = sorted(set(df.select(F.percentile_approx(key, marks, max(1000, 10 * cuts))).first()[0]))
    return bucket_of(F.col(key), bounds)


def running_total(df: DataFrame, size: str, order: list[str], rows_per_bucket: int = 20_000) -> DataFrame:
    """``df`` with ``before``: the sum of ``size`` over all rows that come earlier in ``order``.

    Range buckets by the first order column, sums inside each bucket, and sums of the (bounded) buckets; no
    task sees more than a bucket. Materialize ``df`` before, so that ties keep one order.
    """
    df = df.withColumn("bucket", range_buckets(df, order[0], rows_per_bucket))
    totals = df.groupBy("bucket").agg(F.sum(size).alias("total"))
    earlier = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)  # a row for each bucket only
    totals = materialize(totals.select("bucket", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("first")), "totals")
    inside = W.partitionBy("bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumn("before", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return df.join(totals, "bucket").withColumn("before", F.col("before") + F.col("first")).drop("bucket", "first")


def bucket_of(value: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` are below ``value``, as nested comparisons (log2 of their number deep)."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value > F.lit(bounds[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))

    return F.when(value.isNull(), F.lit(-1)).otherwise(search(0, len(bounds)))


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (node, root), root the smallest node reached.

    Alternating large-star and small-star rounds, each written to the shared folder; a hub's rows are
    joined with one row of minima, so they may be split over tasks and no group is gathered.
    Nodes without an edge don't appear. ``rounds`` guards against a run without end: it raises.
    """

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    def large(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(least.select("a", F.col("m").alias("b")))

    now = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    seen = mark(now)
    for _ in range(rounds):
        now = materialize(small(large(now).distinct()).distinct(), "stars")
        was, seen = seen, mark(now)
        if was == seen:
            roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def with_fields(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, *fields])
