"""Corpus pipeline: documents through the training-data operators, stage by stage.

Each stage takes what its predecessor kept, and its result is written as Parquet in the shared
folder and read again by the next. All stages but the last return the columns of ``documents``;
the last adds ``copies``, the number of times the mix takes a document.

Language profiles and the mix's ranks have no SQL counterpart, so there is no oracle: tests hold
the pipeline against a brute-force version.

Columns beyond those of ``documents`` pass through all stages. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontaminate, language_id, line_dedup, minhash, mixing
from sluice.llm.common import cut, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters (null and empty texts too) or in no learned language.
    Learns from the rows of ``docs`` that have a language; without any, all rows go."""
    return language_id.keep(docs, language_id.profiles(docs))


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that equal or nearly equal an earlier one; a document goes if no line
    is left. ``n_chars`` follows the text (null for a null text, which stays)."""
    out = line_dedup.clean(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, that of the smallest id; texts without
    words are in no group. Repeated rows become one."""
    return minhash.dedup(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; null texts and items hold nothing."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents so that sources (null being one) reach their target weights; adds
    ``copies``. Documents without words are not taken."""
    return mixing.mixed(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", unique_lines),
    ("minhash_dedup", unique_documents),
    ("decontamination", uncontaminated),
    ("mixing", mixture),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
