"""Column names that the dataset layout keeps for itself, and how payload columns of such names are stored.

A landed or compacted folder says by its name which batch, version and period it belongs to; a payload column of one of these names
would be shadowed by the folder's. So such a column, in any spelling of its case, is stored under a prefix; a name that begins
with the prefix gets one more, so that no two names meet. Readers take the prefix off again. The stored schema, as commit records
and manifests keep it, names the payload's own name in the field's metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_COL = "_batch_id"
PERIOD_COL = "_period"
VERSION_COL = "_version"
INTERNAL = (BATCH_COL, PERIOD_COL, VERSION_COL)
PREFIX = "_payload_"


def stored_name(name: str) -> str:
    return PREFIX + name if name.lower() in INTERNAL or name.lower().startswith(PREFIX) else name


def payload_name(stored: str) -> str:
    return stored[len(PREFIX):] if stored.startswith(PREFIX) else stored


def as_stored(df: DataFrame, but: tuple = ()) -> DataFrame:
    """``df`` with its columns under the names they are stored by; those in ``but`` aren't payload."""
    return df.select(*(F.col(f"`{c}`").alias(c if c in but else stored_name(c)) for c in df.columns))


def as_payload(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").alias(payload_name(c)) for c in df.columns))


def stored_schema(schema: T.StructType) -> T.StructType:
    """``schema`` (of stored names) with the payload's own names in the metadata of the fields that are prefixed."""
    return T.StructType([T.StructField(f.name, f.dataType, f.nullable, {"payload_name": payload_name(f.name)} if payload_name(f.name) != f.name else {})
                         for f in schema.fields])
