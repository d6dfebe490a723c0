"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents it keeps, with all their
columns, the last one the packed pieces. ``run`` applies them to ``documents`` in turn, each
written as Parquet in the shared folder and read again as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siltbed.llm import line_dedup, mixing, packing, quality, simhash
from siltbed.llm.common import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, shingle=4, bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), length=2048, end=1)


STAGES = [("quality_rules", quality_rules), ("line_dedup", dedup_lines), ("simhash_dedup", dedup_near),
          ("mixing", mix_sources), ("packing", pack)]

#: SQL has neither the trained trees nor the trie join; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
