"""The training corpus from documents: identified, unique, decontaminated, free of secrets, mixed.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as Parquet into
the shared folder and read back; tables that a stage needed on its way are deleted then. All stages but the last return the
columns of documents; the last adds how many words the mix takes from each document (size, source_size, target, taken).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeforge.llm import decontaminate, language, mixing, near_dup, secret_scan
from citeforge.llm.common import free_name, staged, sweep, table, tables_now

#: A document goes if no language is recognised, or with a chance below this (with two families of two languages each, none is).
LEAST_SCORE = 0.25


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which a language is recognised."""
    return language.keep_identified(docs, language.fit(docs), LEAST_SCORE)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near-duplicates."""
    return near_dup.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark window occurs."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, with each secret in its text replaced by a mark; n_chars follows."""
    spot = free_name(docs.columns, "found")
    had = free_name([*docs.columns, spot], "had")
    clean = secret_scan.redact(secret_scan.scan(docs, column=spot).withColumn(had, F.size(spot) > 0), column=spot)
    return clean.withColumn("n_chars", F.when(F.col(had), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with size, source_size, target and taken: the words that the mix takes from it, repeats counted."""
    return mixing.mix(docs, keep=True)


STAGES = [("language_id", identify), ("near_dup", deduplicate), ("decontaminate", decontaminated), ("secret_scan", without_secrets), ("mixing", mixed)]

#: SQL can express neither the language identification nor the stages that build on it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), tables_now()
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        sweep(docs, since=before)
    return docs
