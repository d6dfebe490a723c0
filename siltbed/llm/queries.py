"""Registered queries of the operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm import decontaminate, fingerprints, html_extract, line_dedup, merkle, mixing, packing, pii, quality, secret_scan, simhash, spelling, toxicity
from siltbed.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


@register("op1_mixing", mixing.oracle())
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled documents with their topic, tokens and calibrated probability."""
    got = mixing.with_probability(table(spark, sf_dir, "documents"))
    return got.where("u < p").select("doc_id", "topic", "tokens", F.round("p", 6).alias("probability"))


@register("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.components(table(spark, sf_dir, "documents"), shingle=4, bits=4)
    return got.select("doc_id", simhash.hexed("fp").alias("fingerprint"), "component_id")


@register("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@register("op10_line_dedup", line_dedup.ORACLE)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its repeated lines taken out."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_chars")


@register("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), length=2048, end=1)


@register("op4_fingerprints")
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_and_next(table(spark, sf_dir, "documents"))


@register("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


@register("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


@register("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op6_html_text")
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.train(pages))


@register("op13_merkle", merkle.ORACLE)
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


@register("op12_decontaminate", decontaminate.ORACLE)
def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op11_spelling", spelling.ORACLE)
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.forms(spelling.vocabulary(table(spark, sf_dir, "documents")))
