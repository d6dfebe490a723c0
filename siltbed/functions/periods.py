"""Period keys for compaction groups.

Fixed values (must equal the reference's keys):
  hour  -> YYYYMMDD_HH
  day   -> YYYYMMDD
  week  -> YYYYWww   (ISO week number, two digits)
  month -> YYYYMM
  any other period name -> the day key
Flush file names look like ``data_YYYYMMDD_HHMMSS_<counter>.parquet`` (UTC).

Week year: ``iso`` (default) takes the ISO week-numbering year, so 2024-12-30 is 2025W01.
``calendar`` reproduces the older key, calendar year + ISO week (2024-12-30 -> 2024W01).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIODS = ("hour", "day", "week", "month")
# Fixed value: the accepted flush-file name pattern.
FLUSH_NAME_RE = r"^data_([0-9]{8})_([0-9]{6})_.*\.parquet$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def period_key(ts: Column | str, period: str = "hour", week_year: str = "iso") -> Column:
    """Period key of a timestamp column (session zone UTC)."""
    t = _c(ts)
    if period == "hour":
        return F.date_format(t, "yyyyMMdd_HH")
    if period == "month":
        return F.date_format(t, "yyyyMM")
    if period == "week":
        if week_year not in ("iso", "calendar"):
            raise ValueError(f"week_year must be 'iso' or 'calendar', got {week_year!r}")
        year = F.extract(F.lit("YEAROFWEEK"), t) if week_year == "iso" else F.year(t)
        return F.concat(year.cast("string"), F.lit("W"), F.lpad(F.weekofyear(t).cast("string"), 2, "0"))
    return F.date_format(t, "yyyyMMdd")


def flush_name_ts(name: Column | str) -> Column:
    """Timestamp encoded in a flush file name; null when the name does not match or is no date."""
    n = _c(name)
    stamp = F.concat(F.regexp_extract(n, FLUSH_NAME_RE, 1), F.regexp_extract(n, FLUSH_NAME_RE, 2))
    return F.when(n.rlike(FLUSH_NAME_RE), F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss")))


def period_key_from_name(name: Column | str, period: str = "hour", week_year: str = "iso") -> Column:
    """Period key from a flush file name; null marks a name that is left alone and reported."""
    return period_key(flush_name_ts(name), period, week_year)
