"""Registered queries: each applies one operator to a whole stand-in table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lilt import fixture_views as V
from lilt import schema as S
from lilt.functions import scalar
from lilt.operators import augment, calibration, contour, frames, kernels, quantiles, report

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _cuts(df: DataFrame) -> DataFrame:
    return df.select("feature", "ds", "g", "n", F.get("cuts", F.lit(0)).alias("low"), F.get("cuts", F.lit(1)).alias("high"))


@query
def calib_group_cuts(spark, sf_dir):
    return _cuts(calibration.fit(V.utterances(spark, sf_dir)).where("tier = 'group'"))


@query
def calib_pooled_cuts(spark, sf_dir):
    return _cuts(calibration.fit(V.utterances(spark, sf_dir)).where("tier = 'pooled'")).drop("ds")


@query
def calib_lookup(spark, sf_dir):
    u = V.utterances(spark, sf_dir)
    found = calibration.look_up(u, calibration.fit(u))
    return found.select("id", *[F.get(f"{f.measure}_cuts", F.lit(i)).alias(f"{f.label}_{c}") for f in S.FEATURES for i, c in enumerate(("low", "high"))])


@query
def calib_label(spark, sf_dir):
    u = V.utterances(spark, sf_dir)
    return calibration.apply_labels(u, calibration.fit(u)).select("id", *[f.label for f in S.FEATURES])


@query
def calib_label_lineitem(spark, sf_dir):
    u = V.priced(spark, sf_dir)
    labelled = calibration.apply_labels(u, calibration.fit(u))
    return labelled.groupBy("dataset", "gender", *[f.label for f in S.FEATURES]).agg(F.count(F.lit(1)).alias("n"))


@query
def percentile_linear(spark, sf_dir):
    steps = (5, 25, 50, 75, 95)
    got = quantiles.percentiles(V.utterances(spark, sf_dir), ["dataset"], "f0_median_hz", [q / 100 for q in steps])
    return got.select("dataset", *[F.round(F.col("cuts")[i], 6).alias(f"p{q}") for i, q in enumerate(steps)])


@query
def report_label_counts(spark, sf_dir):
    u = V.utterances(spark, sf_dir).withColumn("age_level", scalar.age_level(F.col("age_years")))
    return report.label_counts(calibration.apply_labels(u, calibration.fit(u)))


@query
def report_range_spread(spark, sf_dir):
    return report.range_spread(V.utterances(spark, sf_dir))


@query
def report_f0_by_gender(spark, sf_dir):
    return report.f0_by_gender(V.utterances(spark, sf_dir))


@query
def totals(spark, sf_dir):
    return report.totals(V.utterances(spark, sf_dir))


@query
def vad_threshold(spark, sf_dir):
    return frames.vad_thresholds(V.track(spark, sf_dir)).select("utt", F.round("threshold_db", 6).alias("threshold_db"))


@query
def vad_runs(spark, sf_dir):
    return frames.runs(V.speech_track(spark, sf_dir))


@query
def vad_bridge_prune(spark, sf_dir):
    return frames.bridge_and_prune(V.speech_track(spark, sf_dir)).select("utt", "frame", "speech")


@query
def restrict_to_speech(spark, sf_dir):
    return frames.restrict_to_speech(V.track(spark, sf_dir), V.late_mask(spark, sf_dir)).select("utt", "frame", "voiced")


@query
def f0_in_range(spark, sf_dir):
    return frames.clip_f0(V.track(spark, sf_dir)).groupBy("utt").agg(F.count_if("voiced").alias("n"), F.round(F.max("f0"), 6).alias("top"))


@query
def octave_global(spark, sf_dir):
    return frames.octave_global(V.track(spark, sf_dir)).select("utt", "frame", F.round("f0", 6).alias("f0"))


@query
def octave_local(spark, sf_dir):
    """Iterative, so SQL can't express it; tests hold it against plain Python."""
    return kernels.octave_local(V.track(spark, sf_dir)).select("utt", "frame", F.round("f0", 6).alias("f0"))


@query
def f0_stats(spark, sf_dir):
    return frames.f0_stats(V.speech_track(spark, sf_dir))


@query
def speech_level(spark, sf_dir):
    return frames.speech_level(V.speech_track(spark, sf_dir))


@query
def noise_floor(spark, sf_dir):
    return frames.noise_floor(V.track(spark, sf_dir))


@query
def durations(spark, sf_dir):
    return frames.durations(V.speech_track(spark, sf_dir))


@query
def snr(spark, sf_dir):
    t = V.speech_track(spark, sf_dir)
    return frames.signal_to_noise(frames.speech_level(t).join(frames.noise_floor(t), "utt"))


def _voiced(spark, sf_dir):
    return contour.voiced_frames(V.track(spark, sf_dir))


@query
def semitones(spark, sf_dir):
    return _voiced(spark, sf_dir).select("utt", "frame", F.round("st", 6).alias("st"))


@query
def frame_gaps(spark, sf_dir):
    return contour.frame_gaps(_voiced(spark, sf_dir)).select("utt", "frame", "gap")


@query
def long_pauses(spark, sf_dir):
    return contour.long_pauses(contour.voiced_frames(V.track(spark, sf_dir).withColumn("voiced", F.col("rms") > 0.25)))


@query
def norm_position(spark, sf_dir):
    return contour.positions(_voiced(spark, sf_dir)).select("utt", "frame", F.round("t", 6).alias("t"))


@query
def running_median5(spark, sf_dir):
    return contour.running_median(_voiced(spark, sf_dir)).select("utt", "frame", F.round("st", 6).alias("st"))


@query
def savgol_smooth(spark, sf_dir):
    return contour.savgol(_voiced(spark, sf_dir)).select("utt", "frame", F.round("st", 6).alias("st"))


def _fits(spark, sf_dir):
    return contour.fits(contour.moments(contour.positions(_voiced(spark, sf_dir))))


@query
def polyfit_linear(spark, sf_dir):
    return _fits(spark, sf_dir).select("utt", F.round("slope", 6).alias("slope"))


@query
def polyfit_quadratic(spark, sf_dir):
    return _fits(spark, sf_dir).select("utt", F.round("a", 6).alias("a"), F.round("b", 6).alias("b"))


@query
def r2_gain(spark, sf_dir):
    return _fits(spark, sf_dir).select("utt", F.round("r2_gain", 6).alias("r2_gain"))


@query
def turning_point(spark, sf_dir):
    return _fits(spark, sf_dir).select("utt", F.round("turn_position", 4).alias("turn_position"), F.round("turn_depth", 4).alias("turn_depth"))


@query
def head_tail_delta(spark, sf_dir):
    return contour.head_tail(contour.positions(_voiced(spark, sf_dir))).select("utt", F.round("delta", 6).alias("delta"))


def _contours(spark, sf_dir):
    return contour.contours(V.track(spark, sf_dir))


@query
def contour_shape(spark, sf_dir):
    return _contours(spark, sf_dir).select("utt", "contour_shape")


@query
def contour_dynamics(spark, sf_dir):
    return _contours(spark, sf_dir).select("utt", "contour_dynamics")


@query
def contour_confidence(spark, sf_dir):
    return _contours(spark, sf_dir).select("utt", "contour_confidence")


def _gated(spark, sf_dir):
    reliable = V.track(spark, sf_dir).groupBy("utt").agg((F.count_if("voiced") >= 40).alias("f0_reliable"))
    return contour.gate(_contours(spark, sf_dir).join(reliable, "utt"))


@query
def reliability_gate(spark, sf_dir):
    return _gated(spark, sf_dir).select("utt", "contour_shape", "contour_dynamics", "contour_confidence")


@query
def intonation(spark, sf_dir):
    told = contour.intonation(F.col("contour_shape"), F.col("contour_dynamics"), F.col("contour_confidence"))
    return _gated(spark, sf_dir).select("utt", told.alias("intonation"))


@query
def rates(spark, sf_dir):
    u = V.utterances(spark, sf_dir)
    return u.select("id", *[c.alias(n) for n, c in scalar.rates(F.col("articulation_rate_pps"), F.col("f0_range_st"), F.col("f0_median_hz") - 800).items()])


@query
def age_level(spark, sf_dir):
    return V.utterances(spark, sf_dir).select("id", scalar.age_level(F.col("age_years")).alias("age_level"))


@query
def gender_argmax(spark, sf_dir):
    p = F.expr("CASE WHEN doc_id % 10 = 0 THEN NULL ELSE array(doc_id % 7 / 7.0D, n_chars % 7 / 7.0D, length(text) % 5 / 5.0D) END")
    return V.table(spark, sf_dir, "documents").select("doc_id", scalar.argmax_label(p).alias("gender"))


@query
def text_coalesce(spark, sf_dir):
    c = V.chat(spark, sf_dir)
    return c.select("conv_id", "turn", scalar.first_text(c).alias("value"))


@query
def alias_coalesce(spark, sf_dir):
    c = V.chat(spark, sf_dir)
    return c.select("conv_id", "turn", *[v.alias(k) for k, v in scalar.placeholders(c).items()])


@query
def prompt_fill(spark, sf_dir):
    return augment.prompts(V.chat(spark, sf_dir)).select("conv_id", "turn", "_prompt", "_error")


@query
def record_key(spark, sf_dir):
    return augment.keyed(V.chat(spark, sf_dir), F.col("turn")).select("conv_id", "turn", F.col("_key").alias("key"))


@query
def resume_anti_join(spark, sf_dir):
    keyed = augment.keyed(V.chat(spark, sf_dir), F.col("turn"))
    return augment.pending(keyed, keyed.where("conv_id % 2 = 0")).select("conv_id", "turn")


@query
def distinct_keys(spark, sf_dir):
    return augment.keyed(V.chat(spark, sf_dir), F.col("turn")).select(F.col("_key").alias("key")).distinct()


@query
def token_rotate_zip(spark, sf_dir):
    tokens = F.split(F.col("text"), " ")
    flags = F.transform(F.sequence(F.lit(1), F.size(tokens)), lambda i: F.when(i % 3 == 0, 1).otherwise(0))
    pairs = scalar.paired_stress(tokens, flags)
    c = V.chat(spark, sf_dir)
    return c.select("conv_id", "turn", F.size(pairs).alias("n"), F.array_join(scalar.stressed_words(pairs), " ").alias("stressed"))


@query
def nonlatin_guard(spark, sf_dir):
    text = F.when(F.col("id") % 5 == 0, F.concat("transcription", F.lit(" 漢字"))).when(F.col("id") % 5 == 1, F.concat("transcription", F.lit(" Ж"))).otherwise(F.col("transcription"))
    return V.utterances(spark, sf_dir).select("id", scalar.non_latin(text).alias("non_latin"))


@query
def arpabet_filter(spark, sf_dir):
    tokens = F.split(F.translate("transcription", "aehnrst", "AEHNRST"), "[ ,.\n]+")
    return V.utterances(spark, sf_dir).select("id", F.size(scalar.arpabet(tokens)).alias("n_phonemes"))


@query
def error_split(spark, sf_dir):
    j = V.jobs(spark, sf_dir)
    return j.where(F.col("_error").isNotNull()).select("audio_path", scalar.failure_reason(F.col("_error")).alias("error"))


@query
def error_top5(spark, sf_dir):
    return report.top_failures(V.jobs(spark, sf_dir).where(F.col("_error").isNotNull()))


@query
def limit_first_n(spark, sf_dir):
    return V.jobs(spark, sf_dir).orderBy("_row").limit(100).select("audio_path")


@query
def dry_run(spark, sf_dir):
    c = V.chat(spark, sf_dir).withColumn("_row", F.col("conv_id") * 1000 + F.col("turn"))
    return augment.dry_run(c, n=20)


@query
def vocabulary_check(spark, sf_dir):
    told = intonation(spark, sf_dir)
    return told.agg(F.count_if(~F.col("intonation").isin(*S.INTONATIONS)).alias("n_outside"))


@query
def peak_normalise(spark, sf_dir):
    e = V.table(spark, sf_dir, "embeddings")
    scaled = scalar.peak_normalised(F.transform("embedding", lambda x: x.cast("double")))
    return e.select("vec_id", F.round(F.array_max(scaled), 6).alias("top"), F.round(F.array_min(scaled), 6).alias("bottom"))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: records labelled by calibrated cuts of their groups."""
    return calib_label(spark, sf_dir)
