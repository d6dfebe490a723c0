"""Physical plans: filters and pruning reach the scan, hot groups are range-split, broadcasts are small."""

from pyspark.sql import functions as F

from siltbed.plans import catalog_land as CL
from siltbed.plans import catalog_plan as CP
from siltbed.plans.read import read_dataset


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_read_back_prunes_partitions_and_columns(spark, sf_dir):
    opts = CL._land_events(spark, sf_dir, "t_plan_prune")
    q = read_dataset(spark, opts.base).where(F.col("date") >= F.lit(CL.SINCE)).groupBy("_source_id").count()
    p = _plan(q)
    assert "PartitionFilters: [isnotnull(date" in p and "2024-01-15" in p
    assert "ReadSchema: struct<>" in p  # a count reads no data columns


def test_decode_scan_reads_only_needed_columns(spark, sf_dir):
    q = CP.batch_plan(spark, sf_dir)
    p = _plan(q)
    # batch planning never touches the payload: only the id / type / time columns are scanned
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in p
    assert "user_id:" not in p and "props:" not in p
    assert "hashpartitioning(_bucket" in p  # hot sources are split by range buckets, not hashed whole


def test_json_decode_stays_in_the_jvm(spark, sf_dir):
    from siltbed.plans.catalog_decode import json_decode_declared

    p = _plan(json_decode_declared(spark, sf_dir))
    assert "from_json" in p and "PythonUDF" not in p and "BatchEvalPython" not in p


def test_ordinals_dont_rest_on_a_reused_exchange(spark, sf_dir):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        rows = CP.batch_plan(spark, sf_dir).collect()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    per = {}
    for r in rows:
        per.setdefault(r["_source_id"], []).append((r["batch_seq"], r["n_rows"]))
    for batches in per.values():
        assert [b for b, _ in sorted(batches)] == list(range(len(batches)))
        assert all(n == CP.BATCH_SIZE for _, n in sorted(batches)[:-1])
