"""Intonation contour: shape, dynamics and confidence from the voiced frames of an utterance.

Least squares use closed forms of centred sums, so a contour is one chain of windows over the utterance (smoothing, positions)
and one aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lilt import schema as S
from lilt.operators.frames import by_utt, in_order, p

#: Interior weights of a 9-point quadratic smoothing filter (times 231).
SAVGOL = (-21, 14, 39, 54, 59, 54, 39, 14, -21)
TOO_LITTLE = "insufficient_voiced"


def voiced_frames(track: DataFrame) -> DataFrame:
    """Voiced frames with ``st``, semitones from the utterance's median pitch."""
    voiced = track.where(F.col("voiced") & F.col("f0").isNotNull())
    return voiced.withColumn("st", 12 * F.log2(F.col("f0") / p("f0", 0.5).over(by_utt())))


def frame_gaps(voiced: DataFrame) -> DataFrame:
    """voiced with ``gap``: frames since the voiced frame before; null for the first."""
    return voiced.withColumn("gap", F.col("frame") - F.lag("frame").over(in_order()))


def long_pauses(voiced: DataFrame) -> DataFrame:
    """(utt, n_long_pauses): gaps of more than 0.30 s between voiced frames."""
    return frame_gaps(voiced).groupBy("utt").agg(F.count_if(F.col("gap") > S.PAUSE_FRAMES).cast("int").alias("n_long_pauses"))


def positions(voiced: DataFrame) -> DataFrame:
    """voiced with ``t``: place between the first and last voiced frame, 0 to 1."""
    first, last = F.min("frame").over(by_utt()), F.max("frame").over(by_utt())
    return voiced.withColumn("t", (F.col("frame") - first) / F.greatest(last - first, F.lit(1)))


def running_median(voiced: DataFrame, source: str = "st", target: str = "st") -> DataFrame:
    """Median of 5 over the voiced sequence, its ends repeated; sequences below 5 stay as they are."""
    around = in_order().rowsBetween(-2, 2)
    i, n = F.row_number().over(in_order()), F.count(F.lit(1)).over(by_utt())
    ends = voiced.withColumns({"_i": i, "_n": n, "_w": F.collect_list(source).over(around)})
    short = F.lit(5) - F.size("_w")
    pad = F.when(F.col("_i") <= 2, F.array_repeat(F.element_at("_w", 1), short)).otherwise(F.array_repeat(F.element_at("_w", -1), short))
    median = F.element_at(F.array_sort(F.concat("_w", pad)), 3)
    return ends.withColumn(target, F.when(F.col("_n") >= 5, median).otherwise(F.col(source))).drop("_i", "_n", "_w")


def savgol(voiced: DataFrame, source: str = "st", target: str = "st") -> DataFrame:
    """Quadratic smoothing over 9 points; the ends take the quadratic of the first or last 9; below 9 as it is.

    Inner points are weighted sums of their own 9 values; the ends need three sums of the first or last 9 of the utterance.
    """
    own, n = F.row_number().over(in_order()), F.count(F.lit(1)).over(by_utt())
    around = {f"_s{k}": (F.lag(source, -k).over(in_order()) if k < 0 else F.lead(source, k).over(in_order())) for k in range(-4, 5)}
    i, ends = F.col("_i"), {"_h": (F.col("_i") <= 9, F.col("_i") - 5), "_l": (F.col("_i") > F.col("_n") - 9, F.col("_i") - F.col("_n") + 4)}
    sums = {f"{e}{k}": F.sum(F.when(inside, F.col(source) * u**k)).over(by_utt()) for e, (inside, u) in ends.items() for k in range(3)}
    out = voiced.withColumns({"_i": own, "_n": n} | around).withColumns(sums)
    inner = sum((F.col(f"_s{k - 4}") * w for k, w in enumerate(SAVGOL)), F.lit(0.0)) / 231
    fitted = {e: quadratic(*[F.col(f"{e}{k}") for k in range(3)], u) for e, (_, u) in ends.items()}
    value = F.when(F.col("_n") < 9, F.col(source)).when(i <= 4, fitted["_h"]).when(i > F.col("_n") - 4, fitted["_l"]).otherwise(inner)
    return out.withColumn(target, value).drop("_i", "_n", *around, *sums)


def quadratic(y0: Column, y1: Column, y2: Column, u: Column) -> Column:
    """At u, the least-squares quadratic of 9 values at -4 to 4, from their sums with weights 1, u and u squared."""
    s0, s2, s4 = 9, 60, 708
    d = s0 * s4 - s2 * s2
    return (s4 * y0 - s2 * y2) / d + y1 / s2 * u + (s0 * y2 - s2 * y0) / d * u * u


def centred(rows: DataFrame, x: str = "t", y: str = "st") -> DataFrame:
    """rows with ``_x`` and ``_y``: x and y less their means in the utterance."""
    return rows.withColumns({"_x": F.col(x) - F.avg(x).over(by_utt()), "_y": F.col(y) - F.avg(y).over(by_utt())})


def moment_sums(x: str = "t") -> list[Column]:
    """Aggregates over centred() rows: n, mean_t, s2, s3, s4, c1, c2, sst."""
    power = lambda k: F.sum(F.pow("_x", F.lit(k)))
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(x).alias("mean_t"),
        power(2).alias("s2"),
        power(3).alias("s3"),
        power(4).alias("s4"),
        F.sum(F.col("_x") * F.col("_y")).alias("c1"),
        F.sum(F.col("_x") * F.col("_x") * F.col("_y")).alias("c2"),
        F.sum(F.col("_y") * F.col("_y")).alias("sst"),
    ]


def moments(rows: DataFrame, x: str = "t", y: str = "st") -> DataFrame:
    """(utt, n, mean_t, s2, s3, s4, c1, c2, sst): centred sums for linear and quadratic least squares."""
    return centred(rows, x, y).groupBy("utt").agg(*moment_sums(x))


def fits(sums: DataFrame) -> DataFrame:
    """sums with slope, a, b (quadratic), r2_linear, r2_quadratic, r2_gain, turn_position and turn_depth; null where undetermined."""
    det = F.col("s4") - F.col("s3") * F.col("s3") / F.col("s2") - F.col("s2") * F.col("s2") / F.col("n")
    solvable = (F.col("n") >= 3) & (F.col("s2") > 0) & (F.abs(det) > 1e-15)
    a = F.when(solvable, (F.col("c2") - F.col("s3") / F.col("s2") * F.col("c1")) / det)
    out = sums.withColumn("slope", F.when(F.col("s2") > 0, F.col("c1") / F.col("s2"))).withColumn("a", a)
    out = out.withColumn("_b", (F.col("c1") - F.col("a") * F.col("s3")) / F.when(F.col("s2") > 0, F.col("s2")))
    out = out.withColumn("b", F.col("_b") - 2 * F.col("a") * F.col("mean_t"))
    explained = lambda e: F.when(F.col("sst") > 0, e / F.col("sst")).otherwise(0.0)
    out = out.withColumn("r2_linear", explained(F.col("slope") * F.col("c1"))).withColumn("r2_quadratic", explained(F.col("a") * F.col("c2") + F.col("_b") * F.col("c1")))
    turning = F.abs("a") > 1e-9
    vertex = F.when(turning, -F.col("b") / (2 * F.col("a")))
    depth = F.when(turning, -F.col("b") * F.col("b") / (4 * F.col("a")) - (F.col("a") + F.col("b")) / 2)
    return out.withColumns({"r2_gain": F.col("r2_quadratic") - F.col("r2_linear"), "turn_position": vertex, "turn_depth": depth}).drop("_b")


def head_tail_delta() -> Column:
    """Aggregate: median of the last quarter less that of the first, bounds included."""
    part = lambda c: p(F.when(c, F.col("st")), 0.5)
    return part(F.col("t") >= 0.75) - part(F.col("t") <= 0.25)


def head_tail(rows: DataFrame) -> DataFrame:
    """(utt, delta): see head_tail_delta()."""
    return rows.groupBy("utt").agg(head_tail_delta().alias("delta"))


def shape(delta: Column, position: Column, depth: Column, gain: Column) -> Column:
    """A turn inside the utterance decides, else the rise or fall, else level."""
    turn = position.between(S.TURN_FROM, S.TURN_TO) & (F.abs(depth) >= S.MIN_TURN) & (gain >= S.MIN_GAIN)
    turned = F.when(depth > 0, "rising-falling").otherwise("falling-rising")
    straight = F.when(delta >= S.MIN_DELTA, "rising").when(delta <= -S.MIN_DELTA, "falling").otherwise("level")
    return F.when(F.coalesce(turn, F.lit(False)), turned).otherwise(straight)


def dynamics(range_st: Column) -> Column:
    return F.when(range_st < S.FLAT_RANGE, "flat").when(range_st > S.EXPRESSIVE_RANGE, "expressive").otherwise("moderate")


def confidence(shape: Column, delta: Column, depth: Column, voiced_s: Column, pauses: Column) -> Column:
    """Margin beyond the deciding limit, less for little voiced time and for long pauses; 3 places, 0 for other shapes."""
    clip = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    margin = (
        F.when(shape.isin("rising", "falling"), F.abs(delta) / S.MIN_DELTA - 1)
        .when(shape.isin("rising-falling", "falling-rising"), F.abs(depth) / S.MIN_TURN - 1)
        .when(shape == "level", 1 - F.abs(delta) / S.MIN_DELTA)
    )
    # least() and greatest() pass over nulls, so a missing margin is caught first
    return F.when(margin.isNull(), 0.0).otherwise(F.round(clip(margin) * clip(voiced_s) * F.pow(F.lit(0.7), pauses), 3))


def intonation(shape: Column, dynamics: Column, confidence: Column) -> Column:
    """One label from shape, dynamics and confidence."""
    little = shape.isNull() | (shape == TOO_LITTLE)
    directional = shape.isin("rising", "falling", "rising-falling", "falling-rising")
    rest = F.when(directional, shape).when(dynamics == "expressive", "expressive").otherwise("flat")
    return F.when(little, "too_short").when(F.coalesce(confidence, F.lit(0.0)) < S.MIN_CONFIDENCE, "uncertain").otherwise(rest)


def gate(contours: DataFrame, reliable: str = "f0_reliable") -> DataFrame:
    """contours whose shape and dynamics are withheld, with confidence 0, where pitch isn't reliable."""
    bad = ~F.coalesce(F.col(reliable), F.lit(False))
    hide = lambda c: F.when(bad, TOO_LITTLE).otherwise(F.col(c))
    return contours.withColumns({"contour_shape": hide("contour_shape"), "contour_dynamics": hide("contour_dynamics"), "contour_confidence": F.when(bad, 0.0).otherwise(F.col("contour_confidence"))})


def contours(track: DataFrame, smooth: bool = True) -> DataFrame:
    """Contour measures by utterance of a track (utt, frame, f0, voiced); utterances without a voiced frame get the null row."""
    voiced = frame_gaps(voiced_frames(track))
    placed = centred(positions(savgol(running_median(voiced)) if smooth else voiced))
    pauses = F.count_if(F.col("gap") > S.PAUSE_FRAMES).cast("int").alias("n_long_pauses")
    measured = fits(placed.groupBy("utt").agg(*moment_sums(), head_tail_delta().alias("delta"), (p("st", 0.95) - p("st", 0.05)).alias("range_st"), pauses))
    seconds = F.coalesce(F.col("n") * S.HOP_S, F.lit(0.0))
    out = track.select("utt").distinct().join(measured, "utt", "left").withColumn("_s", seconds)
    shaped = (F.col("_s") >= S.MIN_SHAPE_S - 1e-9) & (F.col("n") >= 2)
    moving = (F.col("_s") >= S.MIN_DYNAMICS_S - 1e-9) & (F.col("n") >= 2)
    out = out.withColumn("contour_shape", F.when(shaped, shape(F.col("delta"), F.col("turn_position"), F.col("turn_depth"), F.col("r2_gain"))).otherwise(TOO_LITTLE))
    out = out.withColumn("contour_dynamics", F.when(moving, dynamics(F.col("range_st"))).otherwise(TOO_LITTLE))
    out = out.withColumn("contour_confidence", confidence(F.col("contour_shape"), F.col("delta"), F.col("turn_depth"), F.col("_s"), F.coalesce("n_long_pauses", F.lit(0))))
    only = lambda c, d: F.when(shaped, F.round(c, d))
    return out.select(
        "utt",
        "contour_shape",
        "contour_dynamics",
        "contour_confidence",
        only("delta", 2).alias("contour_delta_st"),
        only("slope", 2).alias("contour_slope_st"),
        only("turn_depth", 2).alias("contour_turn_depth_st"),
        only("turn_position", 3).alias("contour_turn_position"),
        F.coalesce("n_long_pauses", F.lit(0)).alias("contour_n_long_pauses"),
    )
