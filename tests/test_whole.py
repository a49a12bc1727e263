"""Registered queries over whole values, against plain Python and against the SQL written for whole texts."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

from lilt import fixture_views as V
from lilt import oracles, queries
from tests.conftest import SF


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for path in Path(SF).iterdir():
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def test_chat_passes_whole_texts(spark, db):
    want = {(c, t): text if t % 2 else "" for c, t, text in db.sql("SELECT conv_id, turn, text FROM conversations").fetchall()}
    assert max(map(len, want.values())) > 40
    assert {(r.conv_id, r.turn): r.transcription for r in V.chat(spark, SF).collect()} == want
    prompts = {(r.conv_id, r.turn): r for r in queries.prompt_fill(spark, SF).collect()}
    assert all(f"Words: {text}\n" in prompts[k]._prompt for k, text in want.items() if text and prompts[k]._error is None)


@pytest.mark.parametrize("name", ["text_coalesce", "alias_coalesce", "prompt_fill", "dry_run"])
def test_chat_queries_agree_with_sql_over_whole_texts(spark, db, name):
    want = db.sql(oracles.ORACLES[name].replace("substring(text, 1, 40)", "text"))
    columns = sorted(want.columns)
    got = queries.QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.project(", ".join(columns)).fetchall()))


def smoothed(st):
    """Median of 5 with its ends repeated, then the quadratic over 9 points."""
    if len(st) >= 5:
        pad = np.concatenate([st[:1]] * 2 + [st] + [st[-1:]] * 2)
        st = np.median([pad[i : i + len(st)] for i in range(5)], axis=0)
    if len(st) < 9:
        return st
    at = np.clip(np.arange(len(st)), 4, len(st) - 5)
    return np.array([np.polyval(np.polyfit(np.arange(-4, 5), st[a - 4 : a + 5], 2), i - a) for i, a in enumerate(at)])


def described(x):
    """(shape, dynamics, confidence) of the voiced frames of a vector's track, as the labels' definitions say."""
    frame = np.flatnonzero(np.abs(x) > 0.03)
    n = len(frame)
    if n < 25:
        return "insufficient_voiced", "insufficient_voiced", 0.0
    f0 = 130 * 2 ** (x[frame] * 60 / 12)
    st, t = smoothed(12 * np.log2(f0 / np.median(f0))), (frame - frame[0]) / (frame[-1] - frame[0])
    low, high = np.quantile(st, [0.05, 0.95])
    dynamics = "flat" if high - low < 3 else "expressive" if high - low > 9 else "moderate"
    if n < 50:
        return "insufficient_voiced", dynamics, 0.0
    delta = np.median(st[t >= 0.75]) - np.median(st[t <= 0.25])
    line, (a, b, c) = np.polyfit(t, st, 1), np.polyfit(t, st, 2)
    gain = (((st - np.polyval(line, t)) ** 2).sum() - ((st - np.polyval((a, b, c), t)) ** 2).sum()) / ((st - st.mean()) ** 2).sum()
    turn, depth = -b / (2 * a), -b * b / (4 * a) - (a + b) / 2
    if 0.25 <= turn <= 0.75 and abs(depth) >= 2 and gain >= 0.05:
        shape, margin = "rising-falling" if depth > 0 else "falling-rising", abs(depth) / 2 - 1
    elif abs(delta) >= 2:
        shape, margin = "rising" if delta > 0 else "falling", abs(delta) / 2 - 1
    else:
        shape, margin = "level", 1 - abs(delta) / 2
    return shape, dynamics, np.clip(margin, 0, 1) * min(1, n / 100) * 0.7 ** (np.diff(frame) > 30).sum()


def told(shape, dynamics, confidence):
    if shape == "insufficient_voiced":
        return "too_short"
    return "uncertain" if confidence < 0.15 else shape if shape != "level" else "expressive" if dynamics == "expressive" else "flat"


def test_contour_queries_smooth_first(spark, db):
    vectors = {i: np.array(x, np.float32).astype(float) for i, x in db.sql("SELECT vec_id, embedding FROM embeddings").fetchall()}
    want = {i: described(x) for i, x in vectors.items()}
    near = lambda got, i: got == pytest.approx(want[i][2], abs=0.000501)
    assert {r.utt: r.contour_shape for r in queries.contour_shape(spark, SF).collect()} == {i: w[0] for i, w in want.items()}
    assert {r.utt: r.contour_dynamics for r in queries.contour_dynamics(spark, SF).collect()} == {i: w[1] for i, w in want.items()}
    assert all(near(r.contour_confidence, r.utt) for r in queries.contour_confidence(spark, SF).collect())
    gated = queries.reliability_gate(spark, SF).collect()
    assert len(gated) == len(want)
    for r in gated:
        ok = (np.abs(vectors[r.utt]) > 0.03).sum() >= 40
        assert (r.contour_shape, r.contour_dynamics) == (want[r.utt][:2] if ok else ("insufficient_voiced",) * 2)
        assert near(r.contour_confidence, r.utt) if ok else r.contour_confidence == 0
    labels = {r.utt: r.intonation for r in queries.intonation(spark, SF).collect()}
    assert labels == {r.utt: told(r.contour_shape, r.contour_dynamics, r.contour_confidence) for r in gated}
    assert queries.vocabulary_check(spark, SF).first().n_outside == 0


def test_label_counts_take_the_calibrated_levels(spark, db):
    fields = ("pitch_level", "energy_level", "speed_level", "gender", "age_level")
    rows = db.sql(f"WITH {oracles.UTT}, {oracles.CALIB}, {oracles.LOOKUP} SELECT {oracles.LEVELS}, gender, {oracles.AGE} AS age_level FROM found").fetchall()
    want = Counter((f, "None" if x is None else x) for row in rows for f, x in zip(fields, row, strict=True))
    assert {(r.field, r.label): r.n for r in queries.report_label_counts(spark, SF).collect()} == want
