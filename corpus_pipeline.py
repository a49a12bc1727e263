"""From raw documents to token ids: five stages, each written as Parquet before the next one reads it."""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lilt.llm import byte_bpe, jaccard_join, language, line_dedup, mixing
from lilt.llm.common import checkpoint_dir, cut, small

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those that the calibrated model rejects go, null texts among them."""
    told = language.identify(docs, language.train(docs))
    return told.where(~F.col("rejected")).select(*COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long lines that many documents share; n_chars follows the text."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each component of near copies.

    Shingles have five words and the similarity is 0.8 or more. Rows with a null id stay; rows that share an id stay or go
    together.
    """
    found = jaccard_join.jaccard_components(docs, n=5, percent=80)
    gone = cut(found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct())
    return docs.join(small(gone, gone.count()), "doc_id", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it, up to three times."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text of the mix, and whether they decode to it."""
    out = byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    restored = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return out.select("doc_id", "lang", "source", "n_chars", "n_tokens", "token_ids", restored.alias("restored"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("jaccard_join", drop_near_copies),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode_tokens),
]

#: SQL can't express the trained language model or byte-pair merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
