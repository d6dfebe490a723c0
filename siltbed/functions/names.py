"""Flush file names and source folders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flush_file_name(flush_ts: Column | str, counter: Column | str) -> Column:
    """``data_<UTC yyyyMMdd_HHmmss>_<counter, at least 6 digits>.parquet``."""
    ts = F.col(flush_ts) if isinstance(flush_ts, str) else flush_ts
    n = F.col(counter) if isinstance(counter, str) else counter
    return F.concat(F.lit("data_"), F.date_format(ts, "yyyyMMdd_HHmmss"), F.lit("_"),
                    F.format_string("%06d", n.cast("long")), F.lit(".parquet"))


def source_folder(source: Column | str, default: str = "default") -> Column:
    """Folder name a source lands in; untagged rows go to ``default``."""
    s = F.col(source) if isinstance(source, str) else source
    return F.coalesce(s, F.lit(default))
