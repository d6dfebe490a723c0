"""Union of batches whose schemas drifted.

Columns are matched by name; a column missing on one side is null there. Types are
agreed per column before the union: integral and fractional types widen to the widest
numeric type, anything else that disagrees becomes string (complex values as JSON).
The implicit cast of ``unionByName`` is never relied on: under ANSI, long with string
fails at run time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC_RANK = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def _rank(t: T.DataType) -> int | None:
    for i, cls in enumerate(_NUMERIC_RANK):
        if isinstance(t, cls):
            return i
    return None


def common_type(types: list[T.DataType]) -> T.DataType:
    """The type every input type can be cast to without loss of rows."""
    uniq = []
    for t in types:
        if t not in uniq:
            uniq.append(t)
    if len(uniq) == 1:
        return uniq[0]
    ranks = [_rank(t) for t in uniq if not isinstance(t, T.NullType)]
    if ranks and all(r is not None for r in ranks):
        return _NUMERIC_RANK[max(ranks)]()
    non_null = [t for t in uniq if not isinstance(t, T.NullType)]
    if len(non_null) == 1:
        return non_null[0]
    return T.StringType()


def cast_column(c: Column, src: T.DataType, dst: T.DataType) -> Column:
    if src == dst:
        return c
    if isinstance(dst, T.StringType) and isinstance(src, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast(dst)


def agreed_schema(schemas: list[T.StructType]) -> T.StructType:
    """Union of fields (first-seen order), each with its common type."""
    order: list[str] = []
    seen: dict[str, list[T.DataType]] = {}
    for s in schemas:
        for f in s.fields:
            if f.name not in seen:
                order.append(f.name)
                seen[f.name] = []
            seen[f.name].append(f.dataType)
    return T.StructType([T.StructField(n, common_type(seen[n])) for n in order])


def union_widened(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name with per-column type agreement (missing columns -> null)."""
    if not frames:
        raise ValueError("nothing to union")
    target = agreed_schema([f.schema for f in frames])
    aligned = []
    for df in frames:
        have = {f.name: f.dataType for f in df.schema.fields}
        cols = []
        for f in target.fields:
            if f.name in have:
                cols.append(cast_column(F.col(f"`{f.name}`"), have[f.name], f.dataType).alias(f.name))
            else:
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        aligned.append(df.select(*cols))
    return reduce(lambda a, b: a.unionByName(b), aligned)
