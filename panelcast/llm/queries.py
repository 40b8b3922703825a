"""The registered queries of the text operators. The thin ``opN`` queries fix what their contract fixes; the operators'
own modules keep their general interface."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment, grace_dedup, merkle, minhash, nbest, ngram_quality, quotes, random_indexing, secrets, token_count, toxicity,
    url_filter, winnowing,
)
from .common import table
from .oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]

#: The rules of operator 6's contract: (verdict, host, path).
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def op1_nbest_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.report(table(spark, sf_dir, "documents"))


def op2_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_quality.judge(table(spark, sf_dir, "documents"))


def op3_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link(table(spark, sf_dir, "conversations"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return random_indexing.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op7_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"), threshold=85)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace_dedup.groups(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = (
        op1_nbest_encoding, op2_ngram_quality, op3_quote_linking, op4_toxicity, op5_quality,
        op6_url_filter, op7_token_count, op8_secret_scan, op9_decontamination, op10_minhash,
        op11_exact_dedup, op12_alignment, op13_merkle_manifest,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
