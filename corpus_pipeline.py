"""Corpus pipeline: language ID, near-dedup, decontamination, secret redaction, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all
but the last return the columns of ``docs``.  ``run`` writes each stage's rows
as Parquet to the shared folder and reads them back for the next one, so a
lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealens.llm import langid, packing, secrets, simhash, winnow
from arealens.llm.common import new_dir, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised; texts without letters and texts far from
    every centroid go (the model is learned from ``docs`` outside the held-out fold)."""
    others = [c for c in docs.columns if c != "doc_id"]
    found = langid.identify(docs, carry=others)
    return found.filter(~F.col("rejected")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 4-word shingles, at most 4 differing bits."""
    return simhash.keep_one(docs, width=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item."""
    return winnow.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark; ``n_chars`` follows the text."""
    clean = secrets.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids, with the ids."""
    return packing.pack(docs, window=1024, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
    ("redact_secrets", redact_secrets), ("pack", pack)]

# Fingerprints, language model and tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
