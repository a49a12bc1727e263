"""Stand-in records over the general test tables: they exercise the operators, they aren't speech."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature records from documents; empty datasets and null genders, rates and reliabilities are made here."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS id",
        "text AS transcription",
        "CASE WHEN doc_id % 11 = 0 THEN '' ELSE source END AS dataset",
        "CASE WHEN doc_id % 13 = 0 THEN NULL ELSE lang END AS gender",
        "CAST(n_chars AS DOUBLE) AS f0_median_hz",
        "-length(text) / 100.0D AS energy_dbfs",
        "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE round(n_chars / CAST(doc_id % 5 + 1 AS DOUBLE), 3) END AS articulation_rate_pps",
        "CASE WHEN doc_id % 17 = 0 THEN NULL ELSE (n_chars % 97) / 4.0D END AS f0_range_st",
        "CASE WHEN doc_id % 9 = 0 THEN NULL ELSE doc_id % 4 <> 0 END AS f0_reliable",
        "CASE WHEN doc_id % 6 = 0 THEN NULL ELSE CAST(n_chars % 90 AS DOUBLE) END AS age_years",
    )


def track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame track from embeddings: a vector is an utterance, a component a frame."""
    frames = table(spark, sf_dir, "embeddings").selectExpr("vec_id AS utt", "posexplode(embedding) AS (frame, x)")
    return frames.selectExpr("utt", "frame", "130 * pow(2, CAST(x AS DOUBLE) * 60 / 12) AS f0", "abs(CAST(x AS DOUBLE)) AS rms", "abs(CAST(x AS DOUBLE)) > 0.03D AS voiced")


def speech_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """track with a given speech mask."""
    return track(spark, sf_dir).selectExpr("*", "rms > 0.05D AS speech", "rms > 0.05D AS mask")


def late_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A speech mask whose grid starts four frames late, so the first frames of a track have none."""
    return speech_track(spark, sf_dir).selectExpr("utt", "frame + 4 AS frame", "speech")


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records to enrich, from conversations."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id",
        "turn",
        "CASE WHEN turn % 3 = 0 THEN '' ELSE concat(conv_id, '-', turn) END AS audio_path",
        "conv_id AS id",
        "CASE WHEN turn % 2 = 0 THEN '' ELSE text END AS transcription",
        "text",
        "CASE WHEN turn % 5 = 4 THEN NULL ELSE role END AS emotion",
        "CASE WHEN conv_id % 4 = 0 THEN NULL ELSE 'Female' END AS gender",
        "CASE WHEN conv_id % 3 = 0 THEN array() ELSE array(role, 'x') END AS stressed_words",
        "CASE WHEN turn % 4 = 1 THEN 'rising' ELSE NULL END AS intonation",
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with error texts, from events."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS _row",
        "concat('a', event_id, '.wav') AS audio_path",
        "CASE WHEN event_type = 'error' OR event_id % 10 = 0 THEN concat('Traceback\n  in worker\nKind', user_id % 7, ': ', event_type, '\n') ELSE NULL END AS _error",
    )


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature records from lineitem, for calibration at scale."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag AS dataset",
        "l_linestatus AS gender",
        "l_extendedprice AS f0_median_hz",
        "-100 * l_discount AS energy_dbfs",
        "l_quantity AS articulation_rate_pps",
    )
