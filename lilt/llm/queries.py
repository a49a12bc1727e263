"""The registered queries of the training-data operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lilt.llm import byte_bpe, flac, jaccard_join, language, licenses, line_dedup, mixing, substring_dedup, token_files, topk_search


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of each document without the passages that an earlier one holds."""
    out = substring_dedup.dedup_substrings(_documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document by the mix of all sources."""
    mixed = mixing.mix(_documents(spark, sf_dir).select("doc_id", "text", "source"))
    m = mixed.select("doc_id", "mix.*")
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document's ids in the ORC files."""
    path = token_files.scratch(spark)
    token_files.write(_documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.layout(spark, path)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of each document under links of shingle Jaccard 0.9 and more."""
    return jaccard_join.jaccard_components(_documents(spark, sf_dir), n=3, percent=90)


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors for each vector whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk_search.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5, scale=256)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and license labels of each document."""
    return licenses.scan_licenses(_documents(spark, sf_dir), only=["doc_id", "text"]).drop("text", "detections")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's byte-level BPE ids and of what they decode to."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    out = byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each text kept as a FLAC stream, and of what is read back from it."""
    out = flac.media_column(_documents(spark, sf_dir), only=["doc_id", "text"])
    return out.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of each document without the lines that many documents share."""
    out = line_dedup.dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return out.select("doc_id", F.col("lines.n_lines").alias("n_lines"), F.col("lines.n_dropped").alias("n_dropped"), kept.alias("kept_sha256"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, by a model of this table's labelled rows."""
    docs = _documents(spark, sf_dir)
    out = language.identify(docs, language.train(docs), only=["doc_id", "text"])
    return out.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_token_files": op3_token_files,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_exact_topk": op5_exact_topk,
    "op6_license_scan": op6_license_scan,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_flac_media": op8_flac_media,
    "op9_line_dedup": op9_line_dedup,
    "op10_language": op10_language,
}
