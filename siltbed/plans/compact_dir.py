"""Merge the flush files of an existing folder tree (``data_<time>_<n>.parquet``) by folder and period, in place.

1. list the tree with Spark, keep the flush files whose names carry a time, plan the groups (``compact_plan.merge_plan``);
2. read every file's footer, in tasks. A group is merged in the schema that its own files agree on, so no folder's types or
   columns depend on another's. Groups whose files disagree on a type (beyond numeric widening) are reported as
   ``schema_conflict``, groups with a file that has no readable footer as ``unreadable``; both are left alone;
3. groups that hold the same schemas are written by one job; rows and every column's values are held against what was read;
4. a journal decides the swap (:mod:`siltbed.plans.swap`): new files to ``<folder>/merged_<period key>_<id>-<k>.parquet``, sources away.

A merge that died before its journal was complete leaves only a hidden folder, which the next one removes; one that died
after it is finished by the next one first, so no row is lost or doubled. Files of any other name are left alone. A footer is
taken from the file's bytes, so a task holds one flush file at a time.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.periods import PERIODS, period_key_from_name
from siltbed.operators.unions import agreed_schema, union_widened
from siltbed.plans import compact_plan, fs, swap
from siltbed.plans.compact import conflicting, differences, value_sums
from siltbed.session import cut_lineage

REPORT = "dir string, period_key string, n_files long, bytes long, status string, n_rows long"
ROW_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"  # where Spark keeps a file's exact schema
DIR, PERIOD = "_merge_dir", "_merge_period"  # folders of a job's own; a data column of such a name is refused


def list_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(path, dir, name, length) of the flush files below ``folder``; dir is relative to it."""
    if not fs.exists(spark, folder):
        return spark.createDataFrame([], "path string, dir string, name string, length long")
    root = _root(spark, folder)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "data_*.parquet")
             .load(folder).select("path", "length"))
    return files.select("path", _dir(F.col("path"), root).alias("dir"), F.substring_index("path", "/", -1).alias("name"), "length")


def _root(spark: SparkSession, folder: str) -> str:
    system, path = fs._fs(spark, folder)
    return system.makeQualified(path).toString().rstrip("/")


def _dir(path: Column, root: str) -> Column:
    """Folder of a file below the root ('' for the root itself), whatever way the path spells the file scheme."""
    bare = F.regexp_replace(path, "^[a-z0-9]+:/+", "/")
    below = root.split(":", 1)[-1]
    below = "/" + below.lstrip("/")
    return F.substring(F.regexp_replace(bare, "/[^/]*$", ""), len(below) + 2, 1_000_000)


def _plain(uri: Column) -> Column:
    """A file's path as listings spell it, from its URI."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def footer_schema(content: bytes) -> str | None:
    """Spark schema (JSON) of a Parquet file's bytes; None without a readable footer."""
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    try:
        stored = pq.read_schema(pa.BufferReader(content))
        kept = (stored.metadata or {}).get(ROW_SCHEMA)
        schema = T.StructType.fromJson(json.loads(kept)) if kept else from_arrow_schema(stored.remove_metadata())
    except Exception:  # noqa: BLE001 - whatever is wrong with the file, its group is left alone
        return None
    return json.dumps(T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]).jsonValue(), sort_keys=True)


def schemas_of(files: DataFrame) -> DataFrame:
    """``files`` (path, ...) with ``schema_json`` from each file's footer (null: unreadable)."""
    spark = files.sparkSession
    paths = [r[0] for r in files.select("path").collect()]  # the round's files, like any file index

    def footers(batches):
        for batch in batches:
            found = [None if b is None else footer_schema(b) for b in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], ["path", "schema_json"])

    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # one file's bytes at a time
    try:
        read = cut_lineage(spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(footers, "path string, schema_json string"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    return files.join(read, "path", "left")


def compact_dir(spark: SparkSession, folder: str, period: str = "hour", min_files: int = 2, week_year: str = "iso", compression: str = "snappy") -> DataFrame:
    """Merge; returns (dir, period_key, n_files, bytes, status, n_rows) of the groups with at least ``min_files`` files."""
    folder = folder.rstrip("/")
    swap.finish(spark, folder)
    period = period if period in PERIODS else "day"
    listing = cut_lineage(list_folder(spark, folder))
    plan = cut_lineage(compact_plan.merge_plan(listing, period, min_files, week_year))
    if plan.isEmpty():
        return spark.createDataFrame([], REPORT)
    keyed = compact_plan.with_period(compact_plan.candidates(listing), period, week_year).join(plan.select("dir", "period_key"), ["dir", "period_key"], "left_semi")
    files = cut_lineage(schemas_of(keyed.select("path", "dir", "period_key")))
    groups = files.groupBy("dir", "period_key").agg(F.array_sort(F.collect_set("schema_json")).alias("set"), F.count_if(F.col("schema_json").isNull()).alias("broken"))
    groups = cut_lineage(groups)
    job, root = swap.new_job(folder), _root(spark, folder)
    sets = [r[0] for r in groups.where("broken = 0").select("set").distinct().collect()]  # distinct sets of schemas are few
    clashing = [s for s in sets if len(s) > 1 and conflicting(s)]
    merged = [s for s in sets if s not in clashing]
    status = F.when(F.col("broken") > 0, "unreadable")
    for s in clashing:
        status = status.when(F.col("set") == F.lit(s), "schema_conflict")
    groups = groups.withColumn("status", status.otherwise("merged"))
    for k, schemas in enumerate(merged):
        these = groups.where((F.col("status") == "merged") & (F.col("set") == F.lit(schemas))).select("dir", "period_key")
        _merge(spark, files.join(these, ["dir", "period_key"], "left_semi"), schemas, root, period, week_year, compression, f"{job}/rows/set={k}")
    report = plan.join(groups.select("dir", "period_key", "status"), ["dir", "period_key"])
    if not merged:
        return report.withColumn("n_rows", F.lit(None).cast("long")).select(*[c.split()[0] for c in REPORT.split(", ")])
    place = [F.coalesce(swap.folder_value("path", DIR), F.lit("")).alias("dir"), swap.folder_value("path", PERIOD).alias("period_key")]
    counts = spark.read.schema("_nothing int").option("basePath", f"{job}/rows").parquet(f"{job}/rows").select(_plain(F.col("_metadata.file_path")).alias("path"))
    counts = cut_lineage(counts.select(*place).groupBy("dir", "period_key").agg(F.count(F.lit(1)).alias("n_rows")))
    tag = job.rpartition("-")[2][:8]
    made = swap.written(spark, f"{job}/rows").select("path", *place)
    k = F.row_number().over(Window.partitionBy("dir", "period_key").orderBy("path")) - 1
    below = F.when(F.col("dir") == "", F.lit(f"{folder}/")).otherwise(F.concat(F.lit(f"{folder}/"), "dir", F.lit("/")))
    new = made.select("path", F.concat(below, F.lit("merged_"), "period_key", F.lit(f"_{tag}-"), F.format_string("%06d", k), F.lit(".parquet")).alias("target"))
    swap.decide(job, new, files.join(groups.where("status = 'merged'"), ["dir", "period_key"], "left_semi").select("path"))
    swap.finish(spark, folder)
    return report.join(counts, ["dir", "period_key"], "left").select(*[c.split()[0] for c in REPORT.split(", ")])


def _merge(spark: SparkSession, files: DataFrame, schemas: list[str], root: str, period: str, week_year: str, compression: str, out: str) -> None:
    """Write the rows of some groups in the schema theirs agree on; rows and columns written must be those read."""
    by: dict[str, list[str]] = {}
    for sj, path in files.select("schema_json", "path").collect():
        by.setdefault(sj, []).append(path)
    target = agreed_schema([T.StructType.fromJson(json.loads(s)) for s in schemas])
    for f in target.fields:
        if f.name.lower() in (DIR, PERIOD):
            raise ValueError(f"a column is called {f.name!r}, which merging uses itself")
    total, frames, read = F.count(F.lit(1)).alias("rows"), [], []
    for sj, paths in by.items():
        own = T.StructType.fromJson(json.loads(sj))
        rows = spark.read.schema(own).parquet(*paths)
        read.append(rows.agg(total, *value_sums(target, own)).first().asDict())
        path = _plain(rows.metadataColumn("_metadata")["file_path"])
        frames.append(rows.select("*", _dir(path, root).alias(DIR), period_key_from_name(F.substring_index(path, "/", -1), period, week_year).alias(PERIOD)))
    rows = union_widened(frames) if len(frames) > 1 else frames[0]
    (rows.hint("rebalance", DIR, PERIOD).write.option("compression", compression).option("parquet.enable.dictionary", "false")
     .partitionBy(DIR, PERIOD).parquet(out))
    wrote = spark.read.schema(target).parquet(out).agg(total, *value_sums(target, target)).first().asDict()
    differ = differences(read, wrote, target)
    if differ:
        raise RuntimeError(f"merge of {root}: the new files do not hold what was read, by column (values, checksum): {differ}; nothing was changed")
