"""Land decoded rows as partitioned Parquet, one folder per batch, source and partition.

Layout under ``base``::

    land/_batch_id=<id>/_source_id=<s>/<col=value>.../part-*.parquet
    _commits/_batch_id=<id>/part-*.json     one row per committed file
    _quarantine/_batch_id=<id>/reason=<r>/part-*.parquet

Payload columns of the layout's own names are stored under a prefix (:mod:`siltbed.plans.internal`).

Commit protocol (effectively once): a batch whose commit record exists is already durable
and is skipped, so a replayed flush (a retried micro-batch) writes nothing twice. Otherwise
the leftovers of an earlier attempt (one folder) are removed, the rows are appended, and
the commit record naming the written files is written last. Readers only see files named
by a commit record, so a half-written batch stays invisible. Appends need no rename of
partition folders at commit (unlike dynamic partition overwrite), which matters on object
stores. Many batches can be landed by one job (``batch_col``): the planned flushes of a
bounded backfill become one distributed write instead of a loop of small jobs. Their files are
then listed, checked and read some at a time (``FILES_AT_ONCE``), since a listing is held by the driver.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siltbed.functions.names import source_folder
from siltbed.plans import fs
from siltbed.plans.internal import BATCH_COL, as_stored, stored_name, stored_schema
from siltbed.session import cut_lineage, scratch_path
from siltbed.sources.envelope import SOURCE_COL

# Accepted Parquet codecs ("none" = uncompressed).
CODECS = ("snappy", "gzip", "brotli", "zstd", "lz4", "none", "uncompressed")
FLUSH_TS_COL = "flush_ts"
BATCHES_PER_TASK = 100  # commit records that one task writes
FILES_AT_ONCE = 20_000  # files, about, whose listing the driver holds at a time
FIRST_FOLDERS = 200  # batch folders that are listed first; they tell how many files a folder has
COMMIT_SCHEMA = ("path string, length long, flush_ts timestamp, batch_rows long, schema_json string, "
                 "_batch_id string")


@dataclass
class LandOptions:
    base: str
    partition_by: list[str] = field(default_factory=list)
    compression: str = "snappy"
    dictionary: bool = True
    max_records_per_file: int = 0
    query: str = "land"

    def __post_init__(self):
        if not self.base:
            raise ValueError("a base path is required")
        self.compression = (self.compression or "snappy").lower()
        if self.compression not in CODECS:
            raise ValueError(f"unsupported compression {self.compression!r}; expected one of {CODECS}")
        if self.compression == "none":
            self.compression = "uncompressed"
        if "-" in self.query or "/" in self.query:
            raise ValueError("query name may not contain '-' or '/'")

    @property
    def land_dir(self) -> str:
        return f"{self.base.rstrip('/')}/land"

    @property
    def commits_dir(self) -> str:
        return f"{self.base.rstrip('/')}/_commits"

    @property
    def quarantine_dir(self) -> str:
        return f"{self.base.rstrip('/')}/_quarantine"


def check_codec_available(spark, codec: str) -> None:
    """brotli needs a codec class that is often missing: refuse early with a clear message."""
    if codec != "brotli":
        return
    jvm = spark.sparkContext._jvm
    try:
        jvm.java.lang.Class.forName("org.apache.hadoop.io.compress.BrotliCodec")
    except Exception as e:  # noqa: BLE001
        raise ValueError("brotli Parquet codec is not on the classpath; use zstd or gzip") from e


def batch_id_col(opts: LandOptions, seq: Column) -> Column:
    """``<query>-<zero padded sequence>``: sortable, unique per query; null without a sequence number."""
    return F.when(seq.isNotNull(), F.concat(F.lit(f"{opts.query}-"), F.format_string("%012d", seq.cast("long"))))


def batch_id_str(opts: LandOptions, seq: int) -> str:
    return f"{opts.query}-{int(seq):012d}"


def partition_columns(df: DataFrame, opts: LandOptions) -> list[str]:
    """Configured partition columns that exist, by the names they are stored under; absent ones are skipped."""
    return [stored_name(c) for c in opts.partition_by if stored_name(c) in df.columns and c != SOURCE_COL]


def _schema_json(df: DataFrame) -> str:
    return json.dumps(stored_schema(df.schema).jsonValue(), sort_keys=True)


def land(df: DataFrame | list[DataFrame], opts: LandOptions, *, batch_seq: int | None = None, batch_col: str | None = None,
         flush_ts: Column | None = None, batches: DataFrame | None = None, replace: bool = False) -> DataFrame:
    """Write ``df`` (decoded rows with ``_source_id``) and commit it; returns this write's commit rows.

    One batch may have several frames, of sources whose rows differ in schema: each is written in its own, one commit covers all.
    Exactly one of ``batch_seq`` (one batch) or ``batch_col`` (a column numbering many batches).
    ``flush_ts`` (many batches only): per-row time whose max per batch is that batch's flush time.
    ``batches`` (many batches only): the batch plan, columns (``batch_col``, ``flush_ts``), made
    from the envelope's cheap columns; without it the plan is aggregated from ``df`` itself,
    which evaluates ``df`` (e.g. its decode) one extra time. A single batch is stamped with the
    wall-clock time of its flush. ``replace`` rewrites a
    batch that was already committed (only for batches not yet compacted).
    """
    if (batch_seq is None) == (batch_col is None):
        raise ValueError("give either batch_seq or batch_col")
    frames = df if isinstance(df, list) else [df]
    if len(frames) != 1 and batch_seq is None:
        raise ValueError("several frames can only be landed as one batch")
    spark = frames[0].sparkSession
    check_codec_available(spark, opts.compression)
    frames = [_tagged(as_stored(f, but=(SOURCE_COL, batch_col))) for f in frames]
    out = frames[0]

    if batch_seq is not None:
        bid = batch_id_str(opts, batch_seq)
        if not replace and bid in done_batches(spark, opts, [bid]):
            return read_commits(spark, opts.base, bid)  # already durable
        batch_ids = [bid]
        writes = [f.withColumn(BATCH_COL, F.lit(bid)) for f in frames]
    else:
        data = out.withColumn(BATCH_COL, batch_id_col(opts, F.col(batch_col)))
        if batches is not None:
            plan = batches.select(batch_id_col(opts, F.col(batch_col)).alias(BATCH_COL),
                                  F.col(FLUSH_TS_COL).cast("timestamp").alias(FLUSH_TS_COL),
                                  F.lit(None).cast("long").alias("batch_rows"))
        else:
            ts_expr = (flush_ts if flush_ts is not None else F.current_timestamp()).cast("timestamp")
            plan = data.groupBy(BATCH_COL).agg(F.max(ts_expr).alias(FLUSH_TS_COL),
                                               F.count(F.lit(1)).alias("batch_rows"))
        # one row per batch of this write (bounded by the batch count); checkpointed, not recomputed
        flushes = cut_lineage(plan)
        batch_ids = [r[0] for r in flushes.select(BATCH_COL).collect()]
        if None in batch_ids:
            raise ValueError(f"rows without a batch number in {batch_col!r}")
        done = set() if replace else done_batches(spark, opts, batch_ids)
        if done:
            data = data.where(F.col(BATCH_COL).isNull() | ~F.col(BATCH_COL).isin(sorted(done)))
            flushes = flushes.where(~F.col(BATCH_COL).isin(sorted(done)))
            batch_ids = [b for b in batch_ids if b not in done]
        writes = [data.drop(batch_col)]

    # leftovers of a failed attempt (or the replaced batch): commit record first, then data
    for root in (opts.commits_dir, opts.land_dir):
        for name in _existing(spark, root, batch_ids):
            fs.delete(spark, f"{root}/{name}")
    if not batch_ids:
        return spark.createDataFrame([], COMMIT_SCHEMA)
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")  # whatever the session had
    rows_in, files = 0, None
    for data in writes:
        rows_in += _append(data, opts)
        now_there = written_files(spark, opts, batch_ids)
        if now_there is None:
            continue
        # the files of this frame are those that weren't there before
        mine = now_there if files is None else now_there.join(files.select("path"), "path", "left_anti")
        if len(writes) > 1 or batch_col is not None:
            mine = cut_lineage(mine)
        mine = mine.withColumn("schema_json", F.lit(_schema_json(data.drop(BATCH_COL))))
        files = mine if files is None else files.unionByName(mine)

    if batch_seq is not None:
        now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
        flushes = spark.createDataFrame([(bid, now, rows_in)],
                                        f"{BATCH_COL} string, {FLUSH_TS_COL} timestamp_ntz, batch_rows long") \
            .withColumn(FLUSH_TS_COL, F.col(FLUSH_TS_COL).cast("timestamp"))

    # nothing is committed unless the files of the planned batches hold every row (footers only)
    rows_out = 0 if files is None else files.agg(F.sum("n_rows")).first()[0] or 0
    if rows_out != rows_in:
        fs.delete(spark, f"{opts.land_dir}/{BATCH_COL}=__HIVE_DEFAULT_PARTITION__")
        raise RuntimeError(f"{rows_in} rows written but {rows_out} in the planned batches: rows lack a batch of the plan; nothing was committed")
    if files is None:
        return spark.createDataFrame([], COMMIT_SCHEMA)
    commits = (files.join(flushes, BATCH_COL)
               .select(*[c.split()[0] for c in COMMIT_SCHEMA.split(", ")])
               .repartition(1 + len(batch_ids) // BATCHES_PER_TASK, BATCH_COL))  # a batch's record is one file
    commits.write.mode("append").partitionBy(BATCH_COL).json(opts.commits_dir)
    if batch_seq is not None:
        return read_commits(spark, opts.base, bid)
    # what the records say (JSON keeps milliseconds), without listing the records of the whole dataset
    return commits.withColumn(FLUSH_TS_COL, F.date_trunc("millisecond", FLUSH_TS_COL))


def _tagged(df: DataFrame) -> DataFrame:
    src = source_folder(F.col(SOURCE_COL)) if SOURCE_COL in df.columns else F.lit("default")
    return df.withColumn(SOURCE_COL, src)


def _append(data: DataFrame, opts: LandOptions) -> int:
    """Write rows (with their batch id) below the land folder; returns how many there were."""
    obs = Observation()
    part_cols = [BATCH_COL, SOURCE_COL, *partition_columns(data, opts)]
    # rebalance: AQE splits a hot (source, partition) into several tasks and merges small ones
    writer = (data.observe(obs, F.count(F.lit(1)).alias("rows")).hint("rebalance", *part_cols).write.mode("append")
              .option("compression", opts.compression)
              .option("parquet.enable.dictionary", str(opts.dictionary).lower()))
    if opts.max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(opts.max_records_per_file))
    writer.partitionBy(*part_cols).parquet(opts.land_dir)
    return _observed_rows(obs, data)


def _observed_rows(obs: Observation, data: DataFrame) -> int:
    try:
        return int(obs.get.get("rows", 0))
    except Py4JJavaError:  # a plan that the optimizer found to be empty observes nothing
        return data.count()


def _existing(spark, root: str, batch_ids: list[str], chunk: int = 500) -> set[str]:
    """Folder names ``_batch_id=<id>`` under ``root`` among the given ids (one glob, or one plain listing if there are many).

    A glob lists the whole folder, too: globs for one part of the ids after another would cost the square of their number.
    """
    if not batch_ids:
        return set()
    if len(batch_ids) > chunk:
        return fs.names_in(spark, root) & {f"{BATCH_COL}={b}" for b in batch_ids}
    return fs.glob_names(spark, f"{root}/{BATCH_COL}={batch_ids[0]}" if len(batch_ids) == 1 else f"{root}/{BATCH_COL}={{{','.join(batch_ids)}}}")


TOMBSTONES = "t="


def tombstones(spark, base: str) -> tuple[int, dict[str, list[list[int]]]]:
    """Batches whose commit records ``vacuum`` has removed, as ranges of sequence numbers per query."""
    n, text = fs.newest(spark, f"{base.rstrip('/')}/_tombstones", TOMBSTONES)
    return n, json.loads(text) if text else {}


def bury(spark, base: str, batch_ids: list[str]) -> None:
    """Add batches to the tombstones; neighbouring numbers share a range."""
    n, known = tombstones(spark, base)
    for query in {b.rpartition("-")[0] for b in batch_ids}:
        spans = [*known.get(query, []), *([int(b.rpartition("-")[2])] * 2 for b in batch_ids if b.rpartition("-")[0] == query)]
        merged: list[list[int]] = []
        for lo, hi in sorted(spans):
            if merged and lo <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], hi)
            else:
                merged.append([lo, hi])
        known[query] = merged
    fs.publish(spark, f"{base.rstrip('/')}/_tombstones", TOMBSTONES, n, json.dumps(known, sort_keys=True))


def done_batches(spark, opts: LandOptions, batch_ids: list[str]) -> set[str]:
    """Those of the given batches that are committed, or were and have been vacuumed."""
    done = {n.split("=", 1)[1] for n in _existing(spark, opts.commits_dir, batch_ids)
            if fs.exists(spark, f"{opts.commits_dir}/{n}")}
    spans = tombstones(spark, opts.base)[1].get(opts.query, [])
    return done | {b for b in batch_ids if any(lo <= int(b.rpartition("-")[2]) <= hi for lo, hi in spans)}


def _batch_dirs(spark, opts: LandOptions, batch_ids: list[str]) -> list[str]:
    return [f"{opts.land_dir}/{name}" for name in sorted(_existing(spark, opts.land_dir, batch_ids))]


def written_files(spark, opts: LandOptions, batch_ids: list[str]) -> DataFrame | None:
    """(path, length, n_rows, batch id) of the files in the given batch folders; None without one.

    The driver holds a listing's files in memory (some kilobytes each), so of many folders some are listed at a time, and what was found is
    kept in the shared scratch folder.
    """
    dirs = _batch_dirs(spark, opts, batch_ids)
    if not dirs:
        return None
    if len(dirs) <= FIRST_FOLDERS:
        return _files_in(spark, dirs)
    kept, at, size = scratch_path(spark, "written_files"), 0, FIRST_FOLDERS
    while at < len(dirs):
        found, obs, now = _files_in(spark, dirs[at:at + size]), Observation(), len(dirs[at:at + size])
        found.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(kept)
        at, size = at + now, max(1, FILES_AT_ONCE * now // max(1, _observed_rows(obs, found)))
    return spark.read.schema(found.schema).parquet(kept)


def _files_in(spark, dirs: list[str]) -> DataFrame:
    """One listing of the folders (by Spark, in parallel when many); of the files' content only footers are read, for the row counts."""
    with fs.many_folders(spark):
        rows = spark.read.schema("_nothing int").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(*dirs)
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    return (rows.select(path.alias("path"), F.col("_metadata.file_size").alias("length")).coalesce(fs.FEW_TASKS)
            .groupBy("path", "length").agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn(BATCH_COL, F.regexp_extract("path", r"/_batch_id=([^/]+)/", 1)))


def read_commits(spark, base: str, batch_id: str | list[str] | None = None) -> DataFrame:
    """Commit rows of a dataset, or of one or some batches (empty frame when nothing was committed)."""
    root = f"{base.rstrip('/')}/_commits"
    some = [batch_id] if isinstance(batch_id, str) else batch_id
    paths = [root] if some is None else [f"{root}/{BATCH_COL}={b}" for b in some]
    if len(paths) == 1 and not fs.exists(spark, paths[0]) or not paths:
        return spark.createDataFrame([], COMMIT_SCHEMA)
    with fs.many_folders(spark):
        return spark.read.schema(COMMIT_SCHEMA).option("basePath", root).json(paths).coalesce(fs.FEW_TASKS)


def batch_groups(commits: DataFrame, files: int | None = None) -> Iterator[list[str]]:
    """Ids of the batches of these commit rows, in groups of at most so many files (or of one batch that has more), to be read one after another."""
    files = files or FILES_AT_ONCE
    group, held = [], 0
    for batch, n in commits.groupBy(BATCH_COL).count().orderBy(BATCH_COL).collect():
        if group and held + n > files:
            yield group
            group, held = [], 0
        group.append(batch)
        held += n
    if group:
        yield group


def land_quarantine(bad: DataFrame, opts: LandOptions, batch_seq: int | None = None,
                    batch_col: str | None = None) -> None:
    """Bad messages with their reason, kept raw for replay or inspection.

    A replay replaces what it wrote before: partitions (batch, reason) are overwritten, none is appended to.
    """
    bid = F.lit(batch_id_str(opts, batch_seq)) if batch_seq is not None else batch_id_col(opts, F.col(batch_col))
    q = bad.withColumn(BATCH_COL, bid)
    if batch_col:
        q = q.drop(batch_col)
    (q.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BATCH_COL, "reason").parquet(opts.quarantine_dir))
