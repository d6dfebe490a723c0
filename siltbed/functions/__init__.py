"""Column-expression helpers (JVM-side, codegen-friendly): tags, time parts, period keys, names."""

from siltbed.functions.periods import flush_name_ts, period_key, period_key_from_name
from siltbed.functions.names import flush_file_name, source_folder
from siltbed.functions.timeparts import with_time_partitions

__all__ = ["period_key", "period_key_from_name", "flush_name_ts", "flush_file_name",
           "source_folder", "with_time_partitions"]
