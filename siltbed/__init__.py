"""siltbed: land message streams as partitioned Parquet, compact them, read them back.

Everything is expressed as Spark DataFrame jobs and Structured Streaming queries:
envelope -> decode (good rows / quarantine) -> tag with source -> partitioned landing
-> period compaction with a manifest -> manifest-aware read-back.
"""

from siltbed.sources.envelope import ENVELOPE, SOURCE_COL

__all__ = ["ENVELOPE", "SOURCE_COL"]
__version__ = "0.1.0"
