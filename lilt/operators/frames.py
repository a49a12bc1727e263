"""Frame-track operators: tables with a row per 10 ms frame, (utt, frame, rms, f0, voiced).

An utterance is the partition of every window here; its frames are bounded by the length of a recording, so no window
grows with the data. Windows of one chain share the partitioning by utt, which costs one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lilt import schema as S

def by_utt() -> WindowSpec:
    return Window.partitionBy("utt")


def in_order() -> WindowSpec:
    return by_utt().orderBy("frame")


def decibels(amplitude: Column) -> Column:
    return 20 * F.log10(F.greatest(amplitude, F.lit(S.EPS)))


def p(column: Column | str, q: float) -> Column:
    """Exact percentile with linear interpolation."""
    return F.percentile(column, F.lit(q))


def vad_thresholds(track: DataFrame) -> DataFrame:
    """(utt, threshold_db): 35 dB below the loud level, at least 6 dB above a floor that is well below it, at least 15 dB below the loud level."""
    levels = track.groupBy("utt").agg(F.percentile(decibels(F.col("rms")), F.array(F.lit(0.95), F.lit(0.05))).alias("l"))
    loud, floor = F.col("l")[0], F.col("l")[1]
    base = loud - S.VAD_TOP
    raised = F.when(loud - floor > S.VAD_MIN_RANGE, F.greatest(base, floor + S.VAD_MARGIN)).otherwise(base)
    return levels.select("utt", F.least(raised, loud - S.VAD_MIN_TOP).alias("threshold_db"))


def mark_speech(track: DataFrame) -> DataFrame:
    """track with ``mask``: frames above the utterance's threshold."""
    return track.join(vad_thresholds(track), "utt").withColumn("mask", decibels(F.col("rms")) > F.col("threshold_db")).drop("threshold_db")


def with_islands(track: DataFrame, mask: str = "mask") -> DataFrame:
    """track with ``_from``, ``_to`` and ``_n`` of the maximal run of equal mask values around each frame."""
    island = F.row_number().over(in_order()) - F.row_number().over(Window.partitionBy("utt", mask).orderBy("frame"))
    run = Window.partitionBy("utt", mask, "_island")
    marked = track.withColumn("_island", island)
    return marked.withColumns({"_from": F.min("frame").over(run), "_to": F.max("frame").over(run), "_n": F.count(F.lit(1)).over(run)}).drop("_island")


def runs(track: DataFrame, mask: str = "mask") -> DataFrame:
    """(utt, start, stop, value): run-length encoding of a mask; stop is exclusive."""
    island = F.row_number().over(in_order()) - F.row_number().over(Window.partitionBy("utt", mask).orderBy("frame"))
    grouped = track.withColumn("_island", island).groupBy("utt", mask, "_island")
    return grouped.agg(F.min("frame").alias("start"), (F.max("frame") + 1).alias("stop")).select("utt", "start", "stop", F.col(mask).alias("value"))


def bridge_and_prune(track: DataFrame, mask: str = "mask", min_gap: int = S.MIN_GAP_FRAMES, min_run: int = S.MIN_SPEECH_FRAMES) -> DataFrame:
    """track with ``speech``: inner pauses below min_gap frames filled, then speech runs below min_run frames dropped."""
    ends = with_islands(track, mask).withColumns({"_first": F.min("frame").over(by_utt()), "_last": F.max("frame").over(by_utt())})
    inner = (F.col("_from") > F.col("_first")) & (F.col("_to") < F.col("_last"))
    bridged = ends.withColumn("speech", F.col(mask) | (inner & (F.col("_n") < min_gap))).drop("_from", "_to", "_n", "_first", "_last")
    kept = with_islands(bridged, "speech")
    return kept.withColumn("speech", F.col("speech") & (F.col("_n") >= min_run)).drop("_from", "_to", "_n")


def voice_activity(track: DataFrame) -> DataFrame:
    """track with ``speech``, by level and run lengths."""
    return bridge_and_prune(mark_speech(track)).drop("mask")


def restrict_to_speech(voiced: DataFrame, speech: DataFrame) -> DataFrame:
    """voiced (utt, frame, voiced, ...) with ``voiced`` kept only where speech (utt, frame, speech) says so; absent frames aren't speech."""
    joined = voiced.join(speech.select("utt", "frame", "speech"), ["utt", "frame"], "left")
    return joined.withColumn("voiced", F.col("voiced") & F.coalesce("speech", F.lit(False))).drop("speech")


def clip_f0(track: DataFrame) -> DataFrame:
    """track with pitch outside the valid range made null and unvoiced."""
    ok = F.col("voiced") & F.col("f0").between(S.F0_FLOOR, S.F0_CEILING)
    return track.withColumn("f0", F.when(ok, F.col("f0"))).withColumn("voiced", F.coalesce(ok, F.lit(False)))


def octave_global(track: DataFrame) -> DataFrame:
    """track with voiced pitch more than 9 semitones from the utterance's median moved by an octave if that brings it within 6.

    Utterances with fewer than five voiced frames stay as they are.
    """
    log = F.when(F.col("voiced"), F.log2("f0"))
    centre, n = p(log, 0.5).over(by_utt()), F.count(log).over(by_utt())
    off = 12 * (log - centre)
    up, down = off + 12, off - 12
    moved = F.when(F.abs(up) <= S.GLOBAL_TOLERANCE, F.col("f0") * 2).when(F.abs(down) <= S.GLOBAL_TOLERANCE, F.col("f0") / 2).otherwise(F.col("f0"))
    return track.withColumn("f0", F.when((n >= 5) & (F.abs(off) > S.GLOBAL_DEVIATION), moved).otherwise(F.col("f0")))


def f0_stats(track: DataFrame) -> DataFrame:
    """Pitch statistics by utterance from (utt, frame, f0, voiced, speech); null where nothing is voiced."""
    f0 = F.when(F.col("voiced"), F.col("f0"))
    base = track.withColumn("_centre", p(f0, 0.5).over(by_utt())).withColumn("_st", F.when(F.col("voiced"), 12 * F.log2(F.col("f0") / F.col("_centre"))))
    got = base.groupBy("utt").agg(
        F.percentile(f0, F.array(F.lit(0.5), F.lit(0.05), F.lit(0.95))).alias("q"),
        F.stddev_pop("_st").alias("std"),
        F.count_if("voiced").alias("n"),
        F.count_if(F.col("speech") & F.col("voiced")).alias("in_speech"),
        F.count_if("speech").alias("speech"),
        F.count(F.lit(1)).alias("frames"),
    )
    share = F.when(F.col("speech") > 0, F.col("in_speech") / F.col("speech")).otherwise(0.0)
    return got.select(
        "utt",
        F.round(F.col("q")[0], 2).alias("f0_median_hz"),
        F.round(F.col("q")[1], 2).alias("f0_p5_hz"),
        F.round(F.col("q")[2], 2).alias("f0_p95_hz"),
        F.round(12 * F.log2(F.col("q")[2] / F.col("q")[1]), 2).alias("f0_range_st"),
        F.round("std", 2).alias("f0_std_st"),
        F.col("n").cast("int").alias("n_voiced_frames"),
        F.round(F.col("n") / F.col("frames"), 3).alias("voiced_ratio"),
        F.round(share, 3).alias("voiced_share_of_speech"),
        ((F.col("n") >= S.RELIABLE_FRAMES) & (share >= S.RELIABLE_SHARE)).alias("f0_reliable"),
    )


def speech_level(track: DataFrame) -> DataFrame:
    """(utt, energy_dbfs): level of the root mean square over speech frames; null without any."""
    square = track.groupBy("utt").agg(F.avg(F.when(F.col("speech"), F.col("rms") * F.col("rms"))).alias("m"))
    return square.select("utt", F.when(F.col("m").isNotNull(), F.round(decibels(F.sqrt("m")), 2)).alias("energy_dbfs"))


def noise_floor(track: DataFrame) -> DataFrame:
    """(utt, noise_floor_dbfs): level of the 5th percentile of linear amplitude."""
    return track.groupBy("utt").agg(p("rms", 0.05).alias("q")).select("utt", F.round(decibels(F.col("q")), 2).alias("noise_floor_dbfs"))


def durations(track: DataFrame) -> DataFrame:
    """(utt, duration_s, speech_duration_s, speech_ratio); from the number of frames where samples aren't known."""
    got = track.groupBy("utt").agg((F.count(F.lit(1)) * S.HOP_S).alias("d"), (F.count_if("speech") * S.HOP_S).alias("s"))
    ratio = F.when(F.col("d") > 0, F.col("s") / F.col("d")).otherwise(0.0)
    return got.select("utt", F.round("d", 3).alias("duration_s"), F.round("s", 3).alias("speech_duration_s"), F.round(ratio, 3).alias("speech_ratio"))


def signal_to_noise(levels: DataFrame) -> DataFrame:
    """levels with est_snr_db, the difference of the two rounded levels."""
    return levels.withColumn("est_snr_db", F.round(F.col("energy_dbfs") - F.col("noise_floor_dbfs"), 2))
