"""Frame-track and contour operators against numpy and hand-worked cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lilt.operators import contour, frames


def masks(spark, **patterns):
    rows = [(u, i, c == "T") for u, p in patterns.items() for i, c in enumerate(p)]
    return spark.createDataFrame(rows, "utt string, frame int, mask boolean")


def test_bridge_and_prune(spark):
    cases = {"a": "T" * 5 + "F" * 5 + "T" * 5, "b": "T" * 5 + "F" * 6 + "T" * 5, "c": "TTTTFFFFFTTTT", "d": "FFF" + "T" * 10, "e": "F" * 9 + "TTTT" + "F" * 9}
    want = {"a": "T" * 15, "b": cases["b"], "c": "T" * 13, "d": cases["d"], "e": "F" * 22}
    got = frames.bridge_and_prune(masks(spark, **cases)).orderBy("utt", "frame").collect()
    for u in cases:
        assert "".join("T" if r.speech else "F" for r in got if r.utt == u) == want[u]


def test_runs(spark):
    got = frames.runs(masks(spark, a="TTFFFT")).orderBy("start").collect()
    assert [(r.start, r.stop, r.value) for r in got] == [(0, 2, True), (2, 5, False), (5, 6, True)]


@pytest.mark.parametrize(("loud", "floor", "want"), [(-20, -80, -55), (-20, -45, -39), (-20, -41, -35), (-20, -30, -55)])
def test_thresholds(spark, loud, floor, want):
    levels = [floor] * 50 + [loud] * 51
    rows = [("u", i, float(10 ** (d / 20))) for i, d in enumerate(levels)]
    got = frames.vad_thresholds(spark.createDataFrame(rows, "utt string, frame int, rms double")).first()
    assert got.threshold_db == pytest.approx(want)


def test_pauses(spark):
    rows = [("a", 0), ("a", 30), ("b", 0), ("b", 31)]
    got = contour.long_pauses(spark.createDataFrame(rows, "utt string, frame int")).collect()
    assert {r.utt: r.n_long_pauses for r in got} == {"a": 0, "b": 1}


@pytest.fixture(scope="module")
def track(spark):
    r = np.random.default_rng(3)
    rows = []
    for u, n in enumerate((120, 70, 40, 8, 4, 1)):
        keep = np.sort(r.choice(2 * n, n, replace=False))
        st = 3 * np.sin(np.arange(n) / 9 + u) + r.normal(size=n) / 3
        rows += [(u, int(f), float(150 * 2 ** (s / 12)), True, True) for f, s in zip(keep, st, strict=True)]
        rows += [(u, int(f), None, False, False) for f in set(range(2 * n)) - set(keep.tolist())]
    rows += [(9, i, None, False, False) for i in range(5)]
    return spark.createDataFrame(rows, "utt int, frame int, f0 double, voiced boolean, speech boolean")


def series(df, *columns):
    out = {}
    for r in df.orderBy("utt", "frame").collect():
        out.setdefault(r.utt, []).append(tuple(r[c] for c in columns))
    return {u: np.array(v, float) for u, v in out.items()}


def test_semitones_and_smoothing(spark, track):
    voiced = contour.voiced_frames(track)
    raw = series(voiced, "f0", "st")
    median = series(contour.running_median(voiced), "st")
    smooth = series(contour.savgol(voiced), "st")
    for u, x in raw.items():
        assert np.allclose(x[:, 1], 12 * np.log2(x[:, 0] / np.median(x[:, 0])))
        st, n = x[:, 1], len(x)
        want = st if n < 5 else np.median(np.lib.stride_tricks.sliding_window_view(np.pad(st, 2, mode="edge"), 5), axis=1)
        assert np.allclose(median[u][:, 0], want)
        want = st.copy()
        if n >= 9:
            for i in range(n):
                a = min(max(i - 4, 0), n - 9)
                want[i] = np.polyval(np.polyfit(np.arange(9), st[a : a + 9], 2), i - a)
        assert np.allclose(smooth[u][:, 0], want)


def test_fits(spark, track):
    placed = contour.positions(contour.voiced_frames(track))
    data = series(placed, "t", "st")
    for r in contour.fits(contour.moments(placed)).collect():
        t, y = data[r.utt].T
        if len(t) < 9:
            continue
        line, curve = np.polyfit(t, y, 1), np.polyfit(t, y, 2)
        total = ((y - y.mean()) ** 2).sum()
        gain = 1 - ((y - np.polyval(curve, t)) ** 2).sum() / total - (1 - ((y - np.polyval(line, t)) ** 2).sum() / total)
        vertex = -curve[1] / (2 * curve[0])
        depth = np.polyval(curve, vertex) - (np.polyval(curve, 0) + np.polyval(curve, 1)) / 2
        assert np.allclose([r.slope, r.a, r.b, r.r2_gain, r.turn_position, r.turn_depth], [line[0], curve[0], curve[1], gain, vertex, depth])


def test_contours_have_a_row_for_every_utterance(spark, track):
    got = {r.utt: r for r in contour.contours(track).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 5, 9}
    assert got[9].contour_shape == got[3].contour_shape == "insufficient_voiced" and got[9].contour_confidence == 0
    assert got[2].contour_shape == "insufficient_voiced" and got[2].contour_dynamics != "insufficient_voiced"
    assert got[0].contour_shape in ("rising", "falling", "rising-falling", "falling-rising", "level")


def test_statistics(spark, track):
    got = {r.utt: r for r in frames.f0_stats(track).collect()}
    f0 = np.array([r.f0 for r in track.where("utt = 0 AND voiced").collect()])
    assert got[0].f0_median_hz == pytest.approx(np.median(f0), abs=0.006) and got[0].n_voiced_frames == 120 and got[0].f0_reliable
    assert got[0].f0_std_st == pytest.approx(np.std(12 * np.log2(f0 / np.median(f0))), abs=0.006)
    assert got[9].f0_median_hz is None and got[9].voiced_share_of_speech == 0 and got[9].f0_reliable is False


def test_octaves(spark):
    rows = [("u", i, 100.0 * (2 if i == 3 else 0.5 if i == 5 else 1), True) for i in range(9)] + [("v", i, 100.0 * 2**i, True) for i in range(4)]
    got = frames.octave_global(spark.createDataFrame(rows, "utt string, frame int, f0 double, voiced boolean"))
    assert {r.f0 for r in got.where("utt = 'u'").collect()} == {100.0}
    assert [r.f0 for r in got.where("utt = 'v'").orderBy("frame").collect()] == [100.0, 200.0, 400.0, 800.0]


def test_restriction_and_levels(spark):
    rows = [("u", i, 0.5 if i < 4 else 0.001, True, i < 4) for i in range(8)] + [("v", 0, 0.1, True, False)]
    t = spark.createDataFrame(rows, "utt string, frame int, rms double, voiced boolean, speech boolean")
    kept = frames.restrict_to_speech(t.drop("speech"), t.where("frame < 2"))
    assert kept.where("voiced").count() == 2
    level = {r.utt: r.energy_dbfs for r in frames.speech_level(t).collect()}
    assert level == {"u": pytest.approx(-6.02), "v": None}
    spoken = {r.utt: (r.duration_s, r.speech_duration_s, r.speech_ratio) for r in frames.durations(t).collect()}
    assert spoken == {"u": (0.08, 0.04, 0.5), "v": (0.01, 0.0, 0.0)}
    assert frames.noise_floor(t).where(F.col("utt") == "v").first().noise_floor_dbfs == -20.0
