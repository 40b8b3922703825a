"""A corpus preparation pipeline over ``documents``: each stage is written as Parquet and read again as the next one's input.

Every stage but the last takes and returns the columns of ``documents``; the last returns the encoding of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import minhash, nbest, ngram_quality, secrets, winnowing
from panelcast.llm.common import prepare, table, written

#: Chunks that an encoding worker remembers in each of two generations: an executor of the pipeline still holds what the earlier
#: stages left in its heap, so its workers keep less than those of the encoding alone.
ENCODER_CHUNKS = 150_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside their language's perplexity band go."""
    prepare(spark)
    return ngram_quality.filter_judged(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the document with the least id stays."""
    prepare(spark)
    return minhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark passages go."""
    prepare(spark)
    return winnowing.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark."""
    prepare(spark)
    return secrets.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The N best segmentations of what is left: token counts, scores, digests of the ids, and the round trip."""
    prepare(spark)
    return nbest.report(docs, remembered=ENCODER_CHUNKS)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("encoding", encoding),
]

#: The first stage estimates a language model and the last searches a piece lattice: SQL can't express them. The tests
#: compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
