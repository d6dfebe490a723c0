"""Read a landed dataset back: committed landed files not yet compacted, plus the live
compacted files of the newest manifest.

Files are grouped by the schema their batch was written with (few distinct schemas);
each group is read with its own schema and cast to the agreed one, so schema drift
(added columns, widened types) never breaks a read. Partition columns keep the types
they had when landed (a ``date`` string stays a string). Payload columns get their own names back, whatever the layout calls its.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.operators.unions import agreed_schema, union_widened
from siltbed.plans import fs
from siltbed.plans.internal import BATCH_COL, INTERNAL, PERIOD_COL, as_payload
from siltbed.plans.land import read_commits
from siltbed.plans.swap import folder_value
from siltbed.sources.envelope import SOURCE_COL

MANIFEST_SCHEMA = ("path string, length long, kind string, dir string, period_key string, period string, "
                   "schema_json string")


@dataclass
class DatasetState:
    base: str
    version: int
    commits: DataFrame        # every commit row
    live_land: DataFrame      # committed landed files not folded into a compaction
    manifest: DataFrame       # rows of the newest manifest (empty when never compacted)

    @property
    def live_compacted(self) -> DataFrame:
        return self.manifest.where(F.col("kind") == "live")


def manifest_dir(base: str) -> str:
    return f"{base.rstrip('/')}/_manifest"


VERSIONS = "v="


def latest_version(spark: SparkSession, base: str) -> int:
    """The newest complete manifest version.

    A version is one small file ``_manifest/v=<n>``, created only if missing, that names the folder of its rows; the rows are
    all written before. A writer that dies leaves no version, or an empty file, which is passed over.
    """
    return fs.newest(spark, manifest_dir(base), VERSIONS)[0]


def publish_manifest(spark: SparkSession, base: str, after: int, rows: DataFrame) -> int:
    """Write the rows to a folder of their own, then publish the version that names it."""
    name = f"rows-{uuid.uuid4().hex}"
    rows.select(*[c.split()[0] for c in MANIFEST_SCHEMA.split(", ")]).write.mode("errorifexists").json(f"{manifest_dir(base)}/{name}")
    return fs.publish(spark, manifest_dir(base), VERSIONS, after, name)


def dataset_state(spark: SparkSession, base: str, batches: list[str] | None = None) -> DatasetState:
    """State of a dataset; ``batches`` limits the commit rows to those of some committed batches."""
    version, name = fs.newest(spark, manifest_dir(base), VERSIONS)
    commits = read_commits(spark, base, batches)
    if version:
        manifest = spark.read.schema(MANIFEST_SCHEMA).json(f"{manifest_dir(base)}/{name}")
    else:
        manifest = spark.createDataFrame([], MANIFEST_SCHEMA)
    folded = manifest.where(F.col("kind") == "folded").select("path")
    live_land = commits.join(folded, "path", "left_anti")
    return DatasetState(base, version, commits, live_land, manifest)


def live_land_paths(st: DatasetState, land_dir: str) -> dict[str, list[str]]:
    """Paths to read per schema: a batch folder when all its committed files are live and of one schema, else a source folder of the batch
    likewise, else its live files one by one."""
    files = st.commits.select(BATCH_COL, "path", "schema_json", F.regexp_extract("path", rf"/({BATCH_COL}=[^/]+/{SOURCE_COL}=[^/]+)/", 1).alias("unit"))
    if st.version:
        files = files.join(st.live_land.select("path", F.lit(1).alias("live")), "path", "left")
    else:  # nothing was folded: the commit records need not be read twice
        files = files.withColumn("live", F.lit(1))

    def whole(by: str) -> DataFrame:
        return files.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.count("live").alias("n_live"), F.count_distinct("schema_json").alias("schemas"), F.min("schema_json").alias("schema"))

    out: dict[str, list[str]] = {}
    full = (F.col("n") == F.col("n_live")) & (F.col("schemas") == 1)
    mixed = False
    # one pass: folders to read whole, and batches whose files differ
    for sj, batch in whole(BATCH_COL).where("n_live > 0").select(F.when(full, F.col("schema")), BATCH_COL).collect():
        if sj is None:
            mixed = True
        else:
            out.setdefault(sj, []).append(f"{land_dir}/{BATCH_COL}={batch}")
    if not mixed:
        return out
    rest = whole(BATCH_COL).where(~full & (F.col("n_live") > 0)).select(BATCH_COL)
    files = files.join(rest, BATCH_COL, "left_semi")
    units = whole("unit")
    for sj, unit in units.where(full).select("schema", "unit").collect():
        out.setdefault(sj, []).append(f"{land_dir}/{unit}")
    single = files.join(units.where(~full).select("unit"), "unit", "left_semi").where("live is not null")
    for sj, path in single.select("schema_json", "path").collect():
        out.setdefault(sj, []).append(path)
    return out


def _schema_from_json(s: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(s))


def read_dataset(spark: SparkSession, base: str, include_internal: bool = False, sources: list[str] | None = None,
                 batches: list[str] | None = None) -> DataFrame:
    """All live rows of the dataset under ``base``, or those of some sources, in the types that these agree on.

    A frame's files are listed in the driver. ``batches`` limits it to some committed batches, as far as they aren't compacted (compacted
    rows belong to no batch); with :func:`siltbed.plans.land.batch_groups` a dataset of any number of files is read in parts.
    """
    st = dataset_state(spark, base, batches)
    if sources is not None:
        own = lambda df: df.where(folder_value("path", SOURCE_COL).isin(sources))
        st = DatasetState(st.base, st.version, own(st.commits), own(st.live_land), own(st.manifest))
    land_dir = f"{base.rstrip('/')}/land"
    by_schema = live_land_paths(st, land_dir)
    schemas = {k: _schema_from_json(k) for k in by_schema}
    all_schemas = list(schemas.values()) or [
        _schema_from_json(r[0]) for r in st.commits.select("schema_json").distinct().collect()]
    frames = []
    for sj, paths in by_schema.items():
        sch = T.StructType(list(schemas[sj].fields) + [T.StructField(BATCH_COL, T.StringType())])
        with fs.many_folders(spark):
            frames.append(spark.read.schema(sch).option("basePath", land_dir).parquet(*paths))
    for rows, cs in compacted_frames(spark, base, st.live_compacted) if batches is None else []:
        all_schemas = all_schemas + [cs]
        frames.append(rows)
    if not frames:
        target = agreed_schema(all_schemas) if all_schemas else T.StructType([T.StructField(SOURCE_COL, T.StringType())])
        return as_payload(spark.createDataFrame([], target))
    out = union_widened(frames) if len(frames) > 1 else frames[0]
    if sources is not None:  # a batch folder holds others, too
        out = out.where(F.col(SOURCE_COL).isin(sources))
    if include_internal:
        return out  # beside the layout's columns, payload columns of such names keep their prefix
    return as_payload(out.drop(*[c for c in INTERNAL if c in out.columns]))


def compacted_frames(spark: SparkSession, base: str, files: DataFrame) -> list[tuple[DataFrame, T.StructType]]:
    """Compacted files (path, schema_json, ...) as a frame for each schema, with ``_period``, and that schema."""
    by: dict[tuple[str, str], list[str]] = {}
    for path, sj, kind in files.select("path", "schema_json", F.regexp_extract("path", r"/compacted/([^/=]+)=", 1)).collect():
        by.setdefault((sj, kind), []).append(path)
    out = []
    for (sj, _), paths in by.items():
        schema = _schema_from_json(sj)
        rows = (spark.read.schema(T.StructType([*schema.fields, T.StructField(PERIOD_COL, T.StringType())]))
                .option("basePath", f"{base.rstrip('/')}/compacted").parquet(*paths))
        out.append((rows.select(*(F.col(f"`{f.name}`") for f in schema.fields), PERIOD_COL), schema))
    return out
