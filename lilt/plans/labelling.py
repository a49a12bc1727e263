"""The labelling job: measure, ask the models, fit, label, report."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lilt import schema as S
from lilt.functions import providers
from lilt.functions.phones import count_phones
from lilt.functions.scalar import failure_reason, first_text, rates
from lilt.operators import calibration, contour, frames, report
from lilt.sources import audio, jsonl

#: Recordings of a task.
CLIPS = 64
#: Fields of the input that the job reads, and computed ones that calibration reads; all others pass through unread.
INPUT = {"audio_path": "string", "transcription": "string", "text": "string", "transcript": "string", "n_phonemes": "int"}
COMPUTED = {f.measure: "double" for f in S.FEATURES} | {"f0_range_st": "double", "f0_reliable": "boolean"} | {
    n: "string" for n in S.REPORT_FIELDS if n not in [f.label for f in S.FEATURES]
}


@F.pandas_udf(T.IntegerType())
def phones(texts: pd.Series) -> pd.Series:
    """Phone counts of texts; null where not counted."""
    return texts.map(count_phones).astype("Int32")


@F.pandas_udf(T.StringType())
def unmangled(texts: pd.Series) -> pd.Series:
    """Texts whose wrongly decoded characters are repaired by the ftfy library."""
    import ftfy

    return texts.map(ftfy.fix_text)


def text_of(records: DataFrame) -> Column:
    """The first non-empty text field, repaired where the ftfy library is installed."""
    text = first_text(records)
    return unmangled(text) if importlib.util.find_spec("ftfy") else text


def utterance_features(measured: DataFrame, track: DataFrame) -> DataFrame:
    """One row of features for each measured file, from its voice-activity track."""
    voiced = track.withColumn("voiced", F.col("voiced") & F.col("speech"))
    seconds = measured.select(F.col("audio_path").alias("utt"), F.round(F.col("n_samples") / S.SAMPLE_RATE, 3).alias("_d"))
    out = frames.durations(track).join(seconds, "utt").withColumn("duration_s", F.col("_d")).drop("_d")
    out = out.withColumn("speech_ratio", F.when(F.col("duration_s") > 0, F.round(F.col("speech_duration_s") / F.col("duration_s"), 3)).otherwise(0.0))
    for part in (frames.signal_to_noise(frames.speech_level(track).join(frames.noise_floor(track), "utt")), frames.f0_stats(voiced), contour.contours(voiced)):
        out = out.join(part, "utt")
    out = contour.gate(out)
    return out.withColumn("intonation", contour.intonation(F.col("contour_shape"), F.col("contour_dynamics"), F.col("contour_confidence")))


def dealt(clips: DataFrame) -> DataFrame:
    """Different clips, about CLIPS to a task. Rows are small and work is large, so their number decides, not their bytes."""
    clips = clips.distinct()
    n = max(clips.sparkSession.sparkContext.defaultParallelism, -(-clips.count() // CLIPS))
    return clips.repartition(n, *clips.columns)


def extract(records: DataFrame, scratch: str, speaker: Callable | None = None, stress: Callable | None = None, load: Callable[[str], bytes] = audio.load) -> DataFrame:
    """records with features and ``_error``; computed columns replace same-named ones.

    A path that is null, missing or in a missing folder is a row's error, not the job's. Measured tracks, features and models'
    answers are written once under scratch and read from there. Model factories, if given, see the clips that were measured
    without an error; a clip on which one fails becomes a failed row.
    """
    named = records.withColumns({"audio_path": F.col("audio_path").cast("string"), "_text": text_of(records)})
    wanted = named.where(F.col("audio_path").isNotNull())
    measured = jsonl.settled(audio.measure(dealt(wanted.select("audio_path")), load), f"{scratch}/measured")
    track = frames.voice_activity(audio.to_frames(measured)).persist()
    try:
        features = jsonl.settled(utterance_features(measured, track).withColumnRenamed("utt", "audio_path"), f"{scratch}/measures")
    finally:
        track.unpersist()
    out = named.drop(*[c for c in features.columns if c != "audio_path"], "_error").join(features, "audio_path", "left")
    out = out.join(measured.select("audio_path", "_error"), "audio_path", "left")
    if speaker or stress:
        sound = wanted.join(measured.where(F.col("_error").isNull()).select("audio_path"), "audio_path", "left_semi")
        clips = dealt(sound.select("audio_path", F.col("_text").alias("text")))
        told = jsonl.settled(providers.annotate(clips, lambda path: audio.decode(load(path)), speaker, stress), f"{scratch}/models").withColumnRenamed("text", "_text")
        out = out.drop(*[c for c in told.columns if c not in ("audio_path", "_text")]).join(told, ["audio_path", "_text"], "left")
        out = out.withColumn("_error", F.coalesce("_error", "_failed")).drop("_failed")
    out = out.withColumn("_error", F.when(F.col("audio_path").isNull(), "KeyError: audio_path").otherwise(F.col("_error")))
    counted = phones(F.col("_text"))
    count = F.coalesce(F.col("n_phonemes").cast("int"), counted) if "n_phonemes" in records.columns else counted
    return out.withColumn("n_phonemes", count).drop("_text").withColumns(rates(F.col("n_phonemes"), F.col("duration_s"), F.col("speech_duration_s")))


def split(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, failed): failed rows are audio_path and error."""
    kept = extracted.where(F.col("_error").isNull()).drop("_error")
    return kept, extracted.where(F.col("_error").isNotNull()).select("audio_path", F.col("_error").alias("error"))


def calibrate(features: DataFrame, group_field: str | None = "dataset", percentiles: Sequence[float] = S.PERCENTILES, min_group: int = S.MIN_GROUP, saved: dict | None = None) -> tuple[DataFrame, dict]:
    """Labelled records and the document of thresholds and report; saved thresholds are used instead of fitting if given."""
    fitted = calibration.from_document(features.sparkSession, saved) if saved else calibration.fit(features, group_field, percentiles, min_group)
    fitted = fitted.persist()
    labelled = calibration.apply_labels(features, fitted, group_field)
    document = {"thresholds": saved or calibration.as_document(fitted, percentiles, min_group, group_field), "report": report.as_document(labelled)}
    return labelled, document


def run(
    spark: SparkSession, source: str, output: str, stage: str = "all", limit: int | None = None, features: str | None = None, errors: str | None = None, thresholds: str | None = None,
    speaker: Callable | None = None, stress: Callable | None = None, load: Callable[[str], bytes] = audio.load, **options,
) -> dict:
    """Runs stage "extract", "calibrate" or "all"; returns the document of thresholds and report, empty after extract.

    Extracted features are written before they are calibrated, so relabelling never measures again and calibration reads
    what the run before wrote. Records keep fields that the job doesn't know. There is a file of failures only if any row
    failed; that of an earlier run goes. What the job writes on its way goes at its end.
    """
    features = features or f"{output}.features"
    group = options.get("group_field", "dataset")
    fields = {group: "string"} if group else {}
    if stage in ("all", "extract"):
        scratch, errors = f"{features}.scratch", errors or f"{features}.errors"
        try:
            read = jsonl.read_open(spark, source, fields | INPUT, limit)
            rows = jsonl.settled(extract(read, scratch, speaker, stress, load), f"{scratch}/rows")
            kept, failed = split(rows)
            unchanged = [c for c in read.columns if c in fields | INPUT and c != "n_phonemes"]
            jsonl.write_open(kept.drop(*unchanged), features)
            jsonl.delete(spark, errors)
            if not failed.isEmpty():
                jsonl.write(failed.withColumn("error", failure_reason(F.col("error"))), errors)
        finally:
            jsonl.delete(spark, scratch)
        if stage == "extract":
            return {}
    labelled, document = calibrate(jsonl.read_open(spark, features, fields | COMPUTED), **options)
    jsonl.write_open(labelled.select("_record", *[f.label for f in S.FEATURES]), output)
    jsonl.write_document(document, thresholds or f"{output}.thresholds.json")
    return document
