"""Compact small landed files by period without losing or doubling rows.

1. plan: committed, not yet folded landed files grouped by (folder, period of the
   batch's flush time); groups with at least ``min_files`` files qualify. A live
   compacted file of the same folder and period is folded in again, so a second
   compaction of a period keeps the first one's rows.
2. write the qualifying groups, those of equal schemas in one job, to ``compacted/_version=<uuid>/<folders>/_period=<key>``
   (dictionary encoding off), rebalanced so a huge period becomes several files.
3. check: rows read == rows in the new files (footer counts), and each column's count of values and checksum are the same in the files
   read and the files written, else nothing is published.
4. publish: a new manifest version (one small file, created only if missing) naming live compacted files and the
   landed files now folded in. Old files are removed later by ``vacuum``.

Groups whose batches disagree on a column type (not a plain numeric widening) are
reported as ``schema_conflict`` and left untouched.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.periods import PERIODS, period_key
from siltbed.operators.unions import agreed_schema, cast_column, union_widened
from siltbed.plans import fs
from siltbed.plans.internal import BATCH_COL, PERIOD_COL, VERSION_COL, stored_schema
from siltbed.plans.land import FLUSH_TS_COL, bury, read_commits
from siltbed.plans.read import compacted_frames, dataset_state, publish_manifest
from siltbed.session import cut_lineage
from siltbed.sources.envelope import SOURCE_COL

REPORT_SCHEMA = "dir string, period_key string, n_files long, bytes long, status string, n_rows long"


@dataclass
class CompactOptions:
    period: str = "hour"
    min_files: int = 2
    week_year: str = "iso"
    compression: str = "snappy"
    enabled: bool = True
    max_files: int = 0   # a limit on the files folded per round, if wanted; oldest periods first, the rest wait
    target_file_bytes: int = 128 * 1024 * 1024   # output size: a big period becomes several files


    def __post_init__(self):
        if self.period not in PERIODS:
            self.period = "day"  # any other period name means day
        if self.min_files < 1:
            raise ValueError("min_files must be >= 1")


def _dir_of(path_col: str) -> F.Column:
    """Partition folder of a file (``_source_id=…/<col=…>``), without batch / period levels."""
    return F.regexp_extract(F.col(path_col), r"/(_source_id=.*?)(?:/_period=[^/]+)?/[^/]+$", 1)


def conflicting(schema_jsons: list[str]) -> bool:
    schemas = [T.StructType.fromJson(json.loads(s)) for s in schema_jsons]
    target = agreed_schema(schemas)
    for s in schemas:
        for f in s.fields:
            t = target[f.name].dataType
            if t != f.dataType and not (isinstance(t, (T.LongType, T.DoubleType)) and
                                        isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType,
                                                                T.LongType, T.FloatType))):
                return True
    return False


def plan(spark: SparkSession, base: str, opts: CompactOptions):
    st = dataset_state(spark, base)
    landed = (st.live_land.withColumn("dir", _dir_of("path"))
              .withColumn("period_key", period_key(F.col(FLUSH_TS_COL), opts.period, opts.week_year)))
    groups = (landed.groupBy("dir", "period_key")
              .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").cast("long").alias("bytes"),
                   F.array_sort(F.collect_set("schema_json")).alias("schemas")))
    # distinct schema sets are few; decide conflicts on the driver, map back by a small join
    combos = [r[0] for r in groups.select("schemas").distinct().collect()]
    bad = [c for c in combos if len(c) > 1 and conflicting(c)]
    status = F.when(F.col("n_files") < F.lit(opts.min_files), F.lit("below_min_files"))
    if bad:
        bad_df = spark.createDataFrame([(c,) for c in bad], "schemas array<string>").withColumn("_bad", F.lit(True))
        groups = groups.join(F.broadcast(bad_df), "schemas", "left")
        status = status.when(F.col("_bad"), F.lit("schema_conflict"))
    groups = groups.withColumn("status", status.otherwise(F.lit("merged")))
    if opts.max_files:
        # a bounded round: qualifying groups in period order while the file budget lasts
        w = Window.orderBy("period_key", "dir").rowsBetween(Window.unboundedPreceding, 0)
        running = F.sum(F.when(F.col("status") == "merged", F.col("n_files")).otherwise(F.lit(0))).over(w)
        groups = groups.withColumn("status", F.when((F.col("status") == "merged") & (running > opts.max_files)
                                                    & (running - F.col("n_files") > 0), F.lit("deferred"))
                                   .otherwise(F.col("status")))
    return st, landed, groups.select("dir", "period_key", "n_files", "bytes", "status")


def compact(spark: SparkSession, base: str, opts: CompactOptions | None = None) -> DataFrame:
    """Run one compaction round; returns the report (dir, period_key, n_files, bytes, status, n_rows).

    A group with a file that can't be read is reported as ``unreadable`` and left alone; the others are merged.
    """
    opts = opts or CompactOptions()
    if not opts.enabled:
        return spark.createDataFrame([], REPORT_SCHEMA)
    st, landed, groups = plan(spark, base, opts)
    # the plan must not be recomputed after publishing (its files then count as folded):
    # materialize it once with a reliable checkpoint; it is one row per group
    groups = cut_lineage(groups)
    try:
        return _compact(spark, base, opts, st, landed, groups)
    except RuntimeError:
        raise
    except Exception:
        files = landed.join(groups.where(F.col("status") == "merged").select("dir", "period_key"), ["dir", "period_key"], "left_semi")
        broken = cut_lineage(unreadable(spark, files).select("dir", "period_key").distinct().withColumn("_bad", F.lit(True)))
        if broken.isEmpty():
            raise
        groups = groups.join(broken, ["dir", "period_key"], "left").withColumn(
            "status", F.when(F.col("_bad"), F.lit("unreadable")).otherwise(F.col("status"))).drop("_bad")
        return _compact(spark, base, opts, st, landed, cut_lineage(groups))


def unreadable(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Rows of ``files`` (path, schema_json, ...) whose file lacks a footer or breaks off while it is read."""
    def rows_of(frame, value):
        return frame.select(F.col("_metadata.file_path").alias("path"), value.alias("x")).groupBy("path").agg(F.count("x").alias("n"))

    found = None
    for sj, paths in _paths_by(files, "schema_json").items():
        read = spark.read.option("ignoreCorruptFiles", "true").schema(T.StructType.fromJson(json.loads(sj))).parquet(*paths)
        stored = [c for c in read.columns if f"/{c}=" not in paths[0]] or read.columns
        one = rows_of(read, F.xxhash64(*stored)).join(rows_of(read, F.lit(1)).withColumnRenamed("n", "all"), "path").where("n = all").select("path")
        found = one if found is None else found.unionByName(one)
    return files.join(found, "path", "left_anti") if found is not None else files.limit(0)


def _paths_by(files: DataFrame, key: str) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for k, p in files.select(key, "path").collect():
        out.setdefault(k, []).append(p)
    return out


def _compact(spark: SparkSession, base: str, opts: CompactOptions, st, landed: DataFrame, groups: DataFrame) -> DataFrame:
    merged = groups.where(F.col("status") == "merged")
    chosen = merged.select("dir", "period_key")
    in_land = cut_lineage(landed.join(chosen, ["dir", "period_key"], "left_semi"))
    report = groups.select("dir", "period_key", "n_files", "bytes", "status")
    if in_land.isEmpty():
        return report.withColumn("n_rows", F.lit(None).cast("long"))
    # an earlier output of the period is folded in again, unless it has the target size already
    old_comp = cut_lineage(st.live_compacted.where((F.col("period") == opts.period) & (F.col("length") < opts.target_file_bytes))
                           .join(chosen, ["dir", "period_key"], "left_semi"))
    comp_root = f"{base.rstrip('/')}/compacted"
    version = uuid.uuid4().hex

    # groups that hold the same schemas are rewritten together, in the schema those agree on: no
    # source's types depend on another's. Distinct sets of schemas are few.
    every = in_land.select("dir", "period_key", "schema_json").unionByName(old_comp.select("dir", "period_key", "schema_json"))
    sets = every.groupBy("dir", "period_key").agg(F.array_sort(F.collect_set("schema_json")).alias("set"))
    sets = cut_lineage(sets)
    targets, out_dirs = [], []
    for k, (schemas,) in enumerate(sets.select("set").distinct().collect()):
        target = agreed_schema([T.StructType.fromJson(json.loads(x)) for x in schemas])
        targets.append((schemas, json.dumps(stored_schema(target).jsonValue(), sort_keys=True)))
        these = sets.where(F.col("set") == F.lit(schemas)).select("dir", "period_key")
        out_dirs.append(f"{comp_root}/{VERSION_COL}={version}-{k}")
        _rewrite(spark, opts, in_land.join(these, ["dir", "period_key"], "left_semi"), old_comp.join(these, ["dir", "period_key"], "left_semi"),
                 target, base, out_dirs[-1])
    written = spark.read.schema("_nothing int").option("basePath", comp_root).parquet(*out_dirs)

    agreed = spark.createDataFrame(targets, "set array<string>, schema_json string")
    agreed = sets.join(agreed, "set").select("dir", "period_key", "schema_json")
    new_files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load(out_dirs).select("path", "length")
                 .withColumn("kind", F.lit("live")).withColumn("dir", _dir_of("path"))
                 .withColumn("period_key", F.regexp_extract("path", r"/_period=([^/]+)/[^/]+$", 1))
                 .withColumn("period", F.lit(opts.period)).join(agreed, ["dir", "period_key"]))
    keep_live = st.live_compacted.join(old_comp.select("path"), "path", "left_anti")
    replaced_rows = old_comp.withColumn("kind", F.lit("replaced"))
    folded_now = in_land.select("path", "length", F.lit("folded").alias("kind"), "dir", "period_key",
                                F.lit(opts.period).alias("period"), F.lit(None).cast("string").alias("schema_json"))
    # folded entries are kept only while their batch still has a commit record (vacuum drops both)
    old_folded = st.manifest.where(F.col("kind") == "folded").join(st.commits.select("path"), "path", "left_semi")
    old_dead = st.manifest.where(F.col("kind") == "replaced")
    manifest = keep_live
    for part in (new_files, old_folded, folded_now, old_dead, replaced_rows):
        manifest = manifest.unionByName(part.select(*manifest.columns))
    publish_manifest(spark, base, st.version, manifest)
    counts = (written.select(F.col("_metadata.file_path").alias("path")).select(
        _dir_of("path").alias("dir"), F.regexp_extract("path", r"/_period=([^/]+)/[^/]+$", 1).alias("period_key"))
        .groupBy("dir", "period_key").agg(F.count(F.lit(1)).alias("n_rows")))
    return report.join(cut_lineage(counts), ["dir", "period_key"], "left").select(*[c.split()[0] for c in REPORT_SCHEMA.split(", ")])


def value_sums(target: T.StructType, have: T.StructType) -> list[F.Column]:
    """For each column of ``target`` that ``have`` holds: its number of values and the xor of their hashes, as it is cast to the target."""
    out = []
    types = {f.name: f.dataType for f in have.fields}
    for i, f in enumerate(target.fields):
        if f.name in types:
            c = cast_column(F.col(f"`{f.name}`"), types[f.name], f.dataType)
            if not isinstance(f.dataType, T.AtomicType):
                c = F.when(c.isNotNull(), F.to_json(F.struct(c.alias("x"))))  # maps can't be hashed
            out += [F.count(c).alias(f"n{i}"), F.coalesce(F.bit_xor(F.when(c.isNotNull(), F.xxhash64(c))), F.lit(0)).alias(f"x{i}")]
    return out


def added(sums: list[dict], target: T.StructType) -> list[tuple[str, int, int]]:
    """(column, number of values, checksum) over several frames."""
    out = []
    for i, f in enumerate(target.fields):
        x = 0
        for s in sums:
            x ^= int(s.get(f"x{i}") or 0)
        out.append((f.name, sum(int(s.get(f"n{i}") or 0) for s in sums), x))
    return out


def _rewrite(spark: SparkSession, opts: CompactOptions, in_land: DataFrame, old_comp: DataFrame, target: T.StructType, base: str, out_dir: str) -> None:
    """Write the rows of some groups' files in the schema ``target`` to ``out_dir``, and hold rows and columns against what was read."""
    frames, observed, in_rows = [], [], 0
    total = F.count(F.lit(1)).alias("rows")

    def take(rows: DataFrame, schema: T.StructType) -> DataFrame:
        # what a file holds is observed on the read itself, before anything is joined, dropped, cast or filled
        observed.append((Observation(), rows, schema))
        return rows.observe(observed[-1][0], total, *value_sums(target, schema))

    batch_period = in_land.select(BATCH_COL, F.col("period_key").alias(PERIOD_COL)).distinct()
    for sj, paths in _paths_by(in_land, "schema_json").items():
        fields = T.StructType.fromJson(json.loads(sj))
        rows = spark.read.schema(T.StructType([*fields.fields, T.StructField(BATCH_COL, T.StringType())])).option("basePath", f"{base.rstrip('/')}/land").parquet(*paths)
        in_rows += rows.count()  # footers only
        frames.append(take(rows, fields).join(batch_period, BATCH_COL).drop(BATCH_COL))
    for rows, fields in compacted_frames(spark, base, old_comp):
        in_rows += rows.count()
        frames.append(take(rows, fields))
    rows = union_widened(frames) if len(frames) > 1 else frames[0]
    part_cols = _partition_cols([r[0] for r in in_land.select("dir").distinct().collect()])
    in_bytes = sum(int(f.agg(F.sum("length")).first()[0] or 0) for f in (in_land, old_comp))
    # rows per output file from the inputs' average row size
    per_file = max(1, int(opts.target_file_bytes * in_rows / in_bytes)) if in_bytes and in_rows else 0
    rows = rows.select(*[F.col(f"`{f.name}`") for f in target.fields], PERIOD_COL)
    writer = (rows.hint("rebalance", *part_cols, PERIOD_COL).write.mode("append")
              .option("compression", opts.compression).option("parquet.enable.dictionary", "false"))
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.partitionBy(*part_cols, PERIOD_COL).parquet(out_dir)
    back = spark.read.schema(target).option("basePath", out_dir).parquet(out_dir)
    wrote = back.agg(total, *value_sums(target, target)).first().asDict()
    read = [o.get for o, _, _ in observed]
    if differences(read, wrote, target):  # a task that ran twice counts twice in what is observed: read it again, exactly
        read = [rows.agg(total, *value_sums(target, schema)).first().asDict() for _, rows, schema in observed]
    differ = differences(read, wrote, target)
    if differ or in_rows != wrote["rows"]:
        raise RuntimeError(f"compaction: {in_rows} rows in the files; what the new files do not hold as it was read, by column (values, checksum): {differ}; not published")


def differences(read: list[dict], wrote: dict, target: T.StructType) -> list[str]:
    rows = sum(int(s.get("rows") or 0) for s in read)
    out = [] if rows == wrote["rows"] else [f"{rows} rows read, {wrote['rows']} written"]
    return out + [f"{name}: {was} read, {now} written" for (name, *was), (_, *now) in zip(added(read, target), added([wrote], target)) if was != now]


def _partition_cols(dirs: list[str]) -> list[str]:
    """Partition columns in landed order, from the few distinct folder shapes of the inputs."""
    shapes = {"/".join(part.split("=", 1)[0] for part in d.split("/")) for d in dirs}
    cols: list[str] = []
    for shape in sorted(shapes, key=len, reverse=True):
        for c in shape.split("/"):
            if c and c not in cols:
                cols.append(c)
    return cols or [SOURCE_COL]


def vacuum(spark: SparkSession, base: str, orphan_seconds: float = 86_400) -> int:
    """Remove what the newest manifest no longer needs; returns the number of files removed.

    A landed batch whose every file is folded into a compaction gets a tombstone (a replay of it is skipped), then loses its
    commit record (readers stop looking for it), then its folder. Compacted files the manifest replaced are
    deleted, and so are output folders no manifest names that are older than ``orphan_seconds`` (a crashed
    round's). Run it when no reader still uses an older version.
    """
    st = dataset_state(spark, base)
    root = base.rstrip("/")
    removed = 0
    if st.version:
        folded = st.manifest.where(F.col("kind") == "folded").select("path")
        per_batch = (st.commits.join(folded.withColumn("_f", F.lit(1)), "path", "left")
                     .groupBy(BATCH_COL).agg(F.count(F.lit(1)).alias("n"), F.count("_f").alias("n_folded")))
        done = per_batch.where(F.col("n") == F.col("n_folded")).select(BATCH_COL, "n").collect()  # one row per batch
        if done:
            bury(spark, base, [r[0] for r in done])
        for b, n in done:
            fs.delete(spark, f"{root}/_commits/{BATCH_COL}={b}")
            if fs.delete(spark, f"{root}/land/{BATCH_COL}={b}"):
                removed += int(n)
        replaced = [r[0] for r in st.manifest.where(F.col("kind") == "replaced").select("path").collect()]
        for p in replaced:
            removed += int(fs.delete(spark, p))
        if replaced or done:
            left = read_commits(spark, base).select("path")
            rest = st.live_compacted.unionByName(st.manifest.where(F.col("kind") == "folded").join(left, "path", "left_semi").select(*st.manifest.columns))
            publish_manifest(spark, base, st.version, cut_lineage(rest))
    used = {r[0] for r in dataset_state(spark, base).live_compacted.select(F.regexp_extract("path", r"/compacted/([^/]+)/", 1)).distinct().collect()}
    old = int((time.time() - orphan_seconds) * 1000)
    for name in fs.list_dirs(spark, f"{root}/compacted"):
        if name not in used and fs.modified_before(spark, f"{root}/compacted/{name}", old):
            removed += len(fs.list_files(spark, f"{root}/compacted/{name}"))
            fs.delete(spark, f"{root}/compacted/{name}")
    return removed
