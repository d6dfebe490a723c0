"""Decode envelope values into typed columns; bad messages go to quarantine with a reason.

* ``decode_json``      declared schema, ``from_json`` in PERMISSIVE mode with a corrupt-record column
* ``infer_json_schema`` one distributed aggregation (``schema_of_variant_agg``) over the values;
                        keys are unioned over all rows (not taken from the first row)
* ``decode_arrow_ipc`` every record batch of every IPC payload, via ``mapInArrow``

Quarantine reasons (fixed values): ``null_value`` (tombstone / missing field), ``malformed``
(not JSON), ``not_object`` (valid JSON that is not an object), ``schema_mismatch`` (object whose
fields do not fit the declared types), ``bad_ipc`` (payload is not an Arrow IPC stream).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.sources.envelope import SOURCE_COL, source_id

CORRUPT_COL = "_corrupt_record"
REASON_COL = "reason"
RAW_COL = "_raw_value"
META_COLS = ["kind", SOURCE_COL, "partition", "offset", "arrival_ts"]
QUARANTINE_COLS = META_COLS + ["value", REASON_COL]
POLICIES = ("raise", "log", "ignore")
FORMATS = ("json", "arrow_ipc")


@dataclass
class Decoded:
    """Result of a decode: typed good rows and the quarantined raw messages.

    ``observation`` (declared JSON decode) counts ``rows`` and ``bad`` while the good rows
    are computed, so a caller can skip writing an empty quarantine without another pass.
    """

    good: DataFrame
    quarantine: DataFrame
    observation: Observation | None = None

    def bad_count(self) -> int | None:
        """Bad rows seen by the last action over ``good`` (None when unknown)."""
        if self.observation is None:
            return None
        try:
            return int(self.observation.get.get("bad", 0))
        except Exception:  # noqa: BLE001 - not observed yet
            return None


def check_policy(policy: str) -> str:
    if policy not in POLICIES:
        raise ValueError(f"error policy must be one of {POLICIES}, got {policy!r}")
    return policy


def check_format(value_format: str) -> str:
    """Unknown formats are refused before any query starts (the old behaviour dropped all data)."""
    if value_format not in FORMATS:
        raise ValueError(f"unsupported value format {value_format!r}; expected one of {FORMATS}")
    return value_format


def _with_meta(env: DataFrame) -> DataFrame:
    if SOURCE_COL in env.columns:
        return env
    return env.withColumn(SOURCE_COL, source_id())


def _text(col: str = "value") -> Column:
    return F.col(col).cast("string")


def meta_names(meta: list[str], payload: list[str]) -> dict[str, str]:
    """Landed names of the envelope columns: a payload field of the same name keeps it, the envelope's gets a prefix.

    The source tag keeps its name, as rows are routed by it; a payload field of that name is landed by :func:`payload_names`.
    """
    taken = {p.lower() for p in payload}
    return {c: f"_meta_{c}" if c.lower() in taken and c != SOURCE_COL else c for c in meta}


def payload_names(payload: list[str]) -> dict[str, str]:
    """Landed names of the payload's fields: their own, but for one that is called like the source tag."""
    clash = re.compile(f"(_field_)*{SOURCE_COL}")
    return {p: f"_field_{p}" if clash.fullmatch(p.lower()) else p for p in payload}


def _free_name(name: str, payload: T.StructType) -> str:
    """``name``, with underscores before it until no payload field is called so."""
    taken = {f.name.lower() for f in payload.fields}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _is_object(text: Column) -> Column:
    return text.rlike(r"^\s*\{")


def json_reason(corrupt: Column, text: Column, raw: Column) -> Column:
    """Why a message failed to decode, or null when it decoded."""
    return (F.when(raw.isNull(), F.lit("null_value"))
            .when(corrupt.isNull(), F.lit(None).cast("string"))
            .when(F.try_parse_json(text).isNull(), F.lit("malformed"))
            .when(~_is_object(text), F.lit("not_object"))
            .otherwise(F.lit("schema_mismatch")))


def decode_json(env: DataFrame, schema: T.StructType, policy: str = "log",
                keep_meta: list[str] | None = None) -> Decoded:
    """Declared-schema JSON decode. ``policy``: log = quarantine, ignore = drop, raise = fail."""
    check_policy(policy)
    env = _with_meta(env)
    meta = keep_meta if keep_meta is not None else META_COLS
    corrupt = _free_name(CORRUPT_COL, schema)
    parse_schema = T.StructType(list(schema.fields) + [T.StructField(corrupt, T.StringType())])
    parsed = F.from_json(_text(), parse_schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    staged = env.select(*[F.col(c) for c in meta], F.col("value"), parsed.alias("_d"))
    staged = staged.withColumn(REASON_COL, json_reason(F.col(f"_d.{corrupt}"), _text(), F.col("value")))
    if policy == "raise":
        staged = staged.withColumn(
            REASON_COL, F.when(F.col(REASON_COL).isNotNull(),
                               F.raise_error(F.concat(F.lit("undecodable message, reason="), F.col(REASON_COL),
                                                      F.lit(", offset="), F.col("offset").cast("string"))))
            .otherwise(F.col(REASON_COL)))
    obs = Observation()
    counted = staged.observe(obs, F.count(F.lit(1)).alias("rows"),
                             F.count(F.col(REASON_COL)).alias("bad"))
    names, fields = meta_names(meta, [f.name for f in schema.fields]), payload_names([f.name for f in schema.fields])
    good = counted.where(F.col(REASON_COL).isNull()).select(
        *[F.col(c).alias(names[c]) for c in meta], *[F.col(f"_d.`{f.name}`").alias(fields[f.name]) for f in schema.fields])
    bad = staged.where(F.col(REASON_COL).isNotNull()).select(*[F.col(c) for c in meta], "value", REASON_COL)
    if policy == "ignore":
        bad = bad.limit(0)
    return Decoded(good, bad, obs)


def _settled(t: T.DataType) -> T.DataType:
    """Inferred types as they land: decimals become double, mixed and never seen ones string."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_settled(t.elementType))
    if isinstance(t, T.DecimalType):
        return T.DoubleType()
    if isinstance(t, (T.VariantType, T.NullType)):
        return T.StringType()
    return t


def variant_ddl_to_schema(ddl: str) -> T.StructType:
    """``OBJECT<a: BIGINT, ...>`` from schema_of_variant_agg -> StructType.

    Only the word that opens an object is rewritten, never a (quoted) key; types are then settled on the parsed schema.
    """
    quoted_or_object = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<")
    s = quoted_or_object.sub(lambda m: "STRUCT<" if m.group() == "OBJECT<" else m.group(), ddl.strip())
    parsed = T._parse_datatype_string(s)
    if not isinstance(parsed, T.StructType):
        raise ValueError(f"payloads are not JSON objects: {ddl}")
    return _settled(parsed)


def infer_json_schema(env: DataFrame) -> T.StructType:
    """Schema of all JSON-object values (none: no fields): one partial-aggregated pass, keys unioned over every row."""
    txt = _text()
    v = F.try_parse_json(txt)
    objs = env.where(F.col("value").isNotNull() & _is_object(txt)).select(v.alias("v"))
    row = objs.where(F.col("v").isNotNull()).agg(F.schema_of_variant_agg("v").alias("s")).first()
    if row is None or row["s"] is None or row["s"] == "VOID":
        return T.StructType([])
    return variant_ddl_to_schema(row["s"])


def infer_json_schemas(env: DataFrame) -> dict[str | None, T.StructType]:
    """Schema per source: one pass, a row per source (an untagged message's source is null)."""
    txt = _text()
    objs = _with_meta(env).where(F.col("value").isNotNull() & _is_object(txt)).select(SOURCE_COL, F.try_parse_json(txt).alias("v"))
    rows = objs.where(F.col("v").isNotNull()).groupBy(SOURCE_COL).agg(F.schema_of_variant_agg("v").alias("s")).collect()
    return {r[SOURCE_COL]: variant_ddl_to_schema(r["s"]) for r in rows}


def decode_json_per_source(env: DataFrame, policy: str = "log") -> dict[str | None, tuple[Decoded, T.StructType]]:
    """Infer and decode each source by itself, so that one source's types never depend on another's."""
    env = _with_meta(env)
    out = {}
    for source, schema in infer_json_schemas(env).items():
        out[source] = (decode_json(env.where(F.col(SOURCE_COL).eqNullSafe(F.lit(source))), schema, policy), schema)
    return out


def decode_json_inferred(env: DataFrame, policy: str = "log") -> tuple[Decoded, T.StructType]:
    """Infer once over the data, then decode with the pinned schema (never re-infer per batch)."""
    schema = infer_json_schema(env)
    return decode_json(env, schema, policy), schema


def decode_arrow_ipc(env: DataFrame, schema: T.StructType, policy: str = "log") -> Decoded:
    """Every record batch of every Arrow IPC payload becomes rows; bad payloads are quarantined.

    ``schema`` is the payload schema (declared: mapInArrow needs the output type up front). A payload whose columns
    can't be cast to it is bad as a whole. ``policy``: log = quarantine, ignore = drop, raise = fail.
    Decoding runs per message inside Arrow batches on the executors; rows never pass the driver.
    """
    check_policy(policy)
    env = _with_meta(env).select(*META_COLS, F.col("value").alias(RAW_COL))
    fields = list(schema.fields)
    named = payload_names([f.name for f in fields])
    landed = meta_names(META_COLS, [f.name for f in fields])
    env = env.select(*[F.col(c).alias(landed[c]) for c in META_COLS], RAW_COL)
    meta = [landed[c] for c in META_COLS]
    out_schema = T.StructType(
        [T.StructField(c, env.schema[c].dataType) for c in meta] + [T.StructField(named[f.name], f.dataType) for f in fields]
        + [T.StructField(RAW_COL, T.BinaryType()), T.StructField(REASON_COL, T.StringType())])

    def decode(batches):
        import pyarrow as pa

        arrow_schema = _arrow_out_schema(out_schema)
        kinds = {f.name: f.type for f in arrow_schema}
        for rb in batches:
            raws = rb.column(rb.num_columns - 1).to_pylist()
            tables = []
            for i, raw in enumerate(raws):
                own = {c: rb.column(k)[i] for k, c in enumerate(meta)}
                try:
                    if raw is None:
                        raise ValueError("null_value")
                    with pa.ipc.open_stream(pa.py_buffer(raw)) as reader:
                        t = reader.read_all()
                    n, reason = t.num_rows, None
                    columns = [t.column(f.name).cast(kinds[named[f.name]]) if f.name in t.schema.names else pa.nulls(n, kinds[named[f.name]]) for f in fields]
                except Exception:  # noqa: BLE001 - any payload that doesn't decode goes to quarantine
                    if policy == "raise":
                        raise
                    n, reason = 1, "null_value" if raw is None else "bad_ipc"
                    columns = [pa.nulls(1, kinds[named[f.name]]) for f in fields]
                if not n:
                    continue
                columns = [*(pa.repeat(own[c], n).cast(kinds[c]) if own[c].is_valid else pa.nulls(n, kinds[c]) for c in meta), *columns,
                           pa.array([raw], pa.binary()) if reason else pa.nulls(n, kinds[RAW_COL]),
                           pa.array([reason], pa.string()) if reason else pa.nulls(n, kinds[REASON_COL])]
                tables.append(pa.table(columns, schema=arrow_schema))
            if tables:  # one output table for an input batch, not a tiny one for each message
                yield from pa.concat_tables(tables).combine_chunks().to_batches()

    staged = env.mapInArrow(decode, out_schema)
    good = staged.where(F.col(REASON_COL).isNull()).select(*meta, *[f"`{named[f.name]}`" for f in fields])
    bad = staged.where(F.col(REASON_COL).isNotNull()).select(*[F.col(landed[c]).alias(c) for c in META_COLS], F.col(RAW_COL).alias("value"), REASON_COL)
    if policy == "ignore":
        bad = bad.limit(0)
    return Decoded(good, bad)


def _arrow_out_schema(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema, timestamp_utc=True)


def encode_arrow_ipc(df: DataFrame, block: Column, key_cols: list[str], payload: list[str]) -> DataFrame:
    """Group rows into blocks and encode each block as one Arrow IPC stream (producer side).

    Blocks are bounded by construction (the caller's block key), so a group never grows with the data.
    """
    schema = T.StructType([df.schema[c] for c in key_cols] + [T.StructField("_block", T.LongType()),
                                                              T.StructField("payload", T.BinaryType())])
    data = df.select(*key_cols, block.cast("long").alias("_block"), *payload)

    def enc(table):
        import pyarrow as pa

        body = table.select(payload)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, body.schema) as w:
            w.write_table(body)
        first = {c: table.column(c)[0].as_py() for c in key_cols + ["_block"]}
        out = {c: [first[c]] for c in key_cols + ["_block"]}
        out["payload"] = [sink.getvalue().to_pybytes()]
        return pa.table(out, schema=_arrow_out_schema(schema))

    return data.groupBy(*key_cols, "_block").applyInArrow(enc, schema)
