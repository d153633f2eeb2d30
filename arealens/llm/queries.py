"""Registered queries of the corpus operators (``opN_*``) and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, bestfit, divergence, hilbert, langid, packing, repeats, secrets, shards, simhash, warc,
               winnow, wrappers)
from .common import table
from .oracle import ORACLES


def op1_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids, one row per piece."""
    return packing.pack(table(spark, sf_dir, "documents"), window=1024, with_ids=False)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, max_bits=4)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, weak parts only where complementary parts co-occur."""
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op4_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by its host's inferred wrapper."""
    return wrappers.extract_pages(table(spark, sf_dir, "pages"))


def op5_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back through the chunked record table."""
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    manifest, folder = warc.archive(pages, least_bytes=1000)
    return warc.read_records(manifest, folder).select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


def op6_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest vectors of every vector whose id is divisible by 20."""
    return hilbert.nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op7_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes; equal texts stay together."""
    placed = shards.shard_documents(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_winnow_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items."""
    got = winnow.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows outside the held-out fold."""
    found = langid.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.coalesce(langid.fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op10_column_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that occur elsewhere."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), width=200).drop("kept")


def op11_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in few sequences of at most 1024 ids, one row per piece."""
    return bestfit.pack_best_fit(table(spark, sf_dir, "documents"), window=1024, separator=2)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence between the sources of every language, and every source's own terms."""
    return divergence.source_divergence(table(spark, sf_dir, "documents"), least=10, top=10)


def op13_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's links between two vocabularies, scored by documents per id pair."""
    return alignment.align(table(spark, sf_dir, "documents"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_pack_windows, op2_simhash_near_dedup, op3_secret_scan, op4_wrapper_text, op5_warc_chunks,
    op6_hilbert_neighbours, op7_minimax_shards, op8_winnow_decontamination, op9_language_id, op10_column_repeats,
    op11_complement_packing, op12_source_divergence, op13_pair_bitmaps)}

LLM_ORACLE_SQL: dict[str, str] = dict(ORACLES)
