"""Column functions and operators on small frames built from the driver's tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.names import flush_file_name
from siltbed.functions.periods import period_key, period_key_from_name
from siltbed.operators.decode import check_format, check_policy, variant_ddl_to_schema
from siltbed.operators.unions import common_type, union_widened
from siltbed.sources.envelope import source_id


def _one(spark, expr, **cols):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]).select(expr.alias("x")).first()
    return row["x"]


@pytest.mark.parametrize("day,iso,cal", [
    ("2024-12-30 10:00:00", "2025W01", "2024W01"),
    ("2021-01-03 00:00:00", "2020W53", "2021W53"),
    ("2026-01-01 23:59:59", "2026W01", "2026W01"),
])
def test_week_keys_at_year_end(spark, day, iso, cal):
    ts = F.lit(day).cast("timestamp")
    assert _one(spark, period_key(ts, "week", "iso")) == iso
    assert _one(spark, period_key(ts, "week", "calendar")) == cal


def test_period_keys_from_name(spark):
    name = F.lit("data_20241113_100100_000002.parquet")
    assert _one(spark, period_key_from_name(name, "hour")) == "20241113_10"
    assert _one(spark, period_key_from_name(name, "day")) == "20241113"
    assert _one(spark, period_key_from_name(name, "month")) == "202411"
    for bad in ("merged_20241113.parquet", "data_x.parquet", "part-0.parquet", "data_20241399_100000_1.parquet"):
        assert _one(spark, period_key_from_name(F.lit(bad), "hour")) is None


def test_file_name_counter_grows_past_six_digits(spark):
    ts = F.lit("2024-11-13 10:00:00").cast("timestamp")
    assert _one(spark, flush_file_name(ts, F.lit(7))) == "data_20241113_100000_000007.parquet"
    assert _one(spark, flush_file_name(ts, F.lit(1234567))) == "data_20241113_100000_1234567.parquet"


def test_source_precedence_empty_is_absent(spark):
    df = spark.createDataFrame([("t", "s"), ("", "s"), (None, "s"), (None, ""), (None, None)],
                               "topic string, stream_key string")
    assert [r[0] for r in df.select(source_id()).collect()] == ["t", "s", "s", None, None]


def test_common_type_rules():
    assert common_type([T.IntegerType(), T.LongType()]) == T.LongType()
    assert common_type([T.LongType(), T.DoubleType()]) == T.DoubleType()
    assert common_type([T.LongType(), T.StringType()]) == T.StringType()
    assert common_type([T.NullType(), T.DateType()]) == T.DateType()


def test_union_widened_keeps_every_row(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    a = ev.select("event_id", "user_id")
    b = ev.select("event_id", F.col("user_id").cast("string").alias("user_id"), F.lit(1).alias("extra"))
    out = union_widened([a, b])
    assert dict(out.dtypes) == {"event_id": "bigint", "user_id": "string", "extra": "int"}
    assert out.count() == 2 * ev.count()


def test_variant_ddl_to_schema():
    s = variant_ddl_to_schema("OBJECT<a: BIGINT, b: ARRAY<BIGINT>, c: DECIMAL(3,1), d: VARIANT>")
    assert [f.dataType for f in s.fields] == [T.LongType(), T.ArrayType(T.LongType()), T.DoubleType(), T.StringType()]


def test_policy_and_format_validation():
    with pytest.raises(ValueError):
        check_policy("shrug")
    with pytest.raises(ValueError):
        check_format("avro")
    assert check_format("arrow_ipc") == "arrow_ipc"


def test_policy_raise_fails_the_job(spark, sf_dir):
    from siltbed.operators.decode import decode_json
    from siltbed.plans import fixtures as fx
    from siltbed.plans.catalog_decode import EVENT_SCHEMA
    from siltbed.sources.envelope import with_source

    d = decode_json(with_source(fx.poison_envelope(spark, sf_dir)), EVENT_SCHEMA, policy="raise")
    with pytest.raises(Exception, match="undecodable message"):
        d.good.count()


def test_json_types_flagged_under_declared_schema(spark):
    from siltbed.operators.decode import decode_json

    env = spark.createDataFrame(
        [("a", 1, b'{"n": 1}'), ("a", 2, b"not json"), ("a", 3, b"5"), ("a", 4, b"[1]"), ("a", 5, None),
         ("a", 6, b'{"n": "seven"}')],
        "topic string, offset long, value binary").select(
        F.lit("kafka").alias("kind"), "topic", F.lit(None).cast("string").alias("stream_key"),
        F.lit(0).alias("partition"), "offset", F.lit(dt.datetime(2024, 1, 1)).alias("arrival_ts"), "value")
    d = decode_json(env, T.StructType([T.StructField("n", T.LongType())]))
    reasons = {r["offset"]: r["reason"] for r in d.quarantine.collect()}
    assert reasons == {2: "malformed", 3: "not_object", 4: "not_object", 5: "null_value", 6: "schema_mismatch"}
    assert [r["n"] for r in d.good.collect()] == [1]
