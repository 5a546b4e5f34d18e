"""The registered queries of this folder: each applies one operator, with its production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wakeline.llm import bpe, collocations, extraction, fingerprints, language, leaks, mixing, nearjoin, quality, repair, secrets, sql, suffixes, vectors

#: Ranks of the byte-level vocabulary.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearjoin.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "copy_id")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extract(pages, extraction.fit(pages))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [
        F.size(F.filter("secrets", secrets.of_kind(kind))).cast("long").alias(f"n_{kind}")
        for kind in secrets.BASE_KINDS
    ]
    base = secrets.listed(F.filter("secrets", secrets.of_kind(*secrets.BASE_KINDS)))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), secrets.listed(F.col("secrets")).alias("spans"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = language.identify(documents, language.fit(documents))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
        (F.col("n_bytes") - removed).alias("n_kept"),
        "kept_chars",
        (removed > 0).alias("repeated"),
    )


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = quality.classify(documents, quality.fit(documents))
    return found.withColumn("quality", F.col("accepted").cast("int"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), RANKS, ends=None, decoded="decoded")
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.audit(repair.damaged(conversations), every=conversations)


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", listed, "contaminated", F.col("near_items").alias("n_near"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_html_extraction": op2_html_extraction,
    "op3_secret_scans": op3_secret_scans,
    "op4_language_id": op4_language_id,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_fingerprints": op6_fingerprints,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_source_mixing": op10_source_mixing,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_benchmark_decontamination": op13_benchmark_decontamination,
}

ORACLES: dict[str, str] = {"op11_phrase_collocations": sql.OP11, "op12_conversation_repair": sql.OP12, "op13_benchmark_decontamination": sql.OP13}
