"""Calibration against plain Python, files, whole jobs, streaming, registered queries against DuckDB."""

from __future__ import annotations

import ast
import json
import math
import wave
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lilt import cli, oracles, queries
from lilt import schema as S
from lilt.functions import pitch
from lilt.functions.providers import echo
from lilt.operators import calibration, kernels, report
from lilt.plans import enriching, labelling
from lilt.sources import audio, jsonl
from lilt.streaming import labels
from tests.conftest import ROOT, SF

RECORD = "id long, dataset string, gender string, f0_median_hz double, energy_dbfs double, articulation_rate_pps double"


def percentile(values, q):
    values, at = sorted(values), q / 100 * (len(values) - 1)
    low = math.floor(at)
    return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)


def records(n=400):
    r = np.random.default_rng(1)
    rows = []
    for i in range(n):
        f0 = None if i % 11 == 0 else round(float(r.uniform(60, 400)), 2)
        rows.append((i, ("a", "b", "", None, "c")[i % 5 if i % 50 else 4], ("Male", "Female", None)[i % 3], f0, round(float(r.normal(-30, 5)), 2), None if i % 7 == 0 else round(float(r.uniform(3, 9)), 3)))
    return rows


def label(rows, saved_min=50):
    groups, out = defaultdict(list), []
    columns = [(3, True, S.FEATURES[0]), (4, False, S.FEATURES[1]), (5, False, S.FEATURES[2])]
    key = lambda row, extra: (row[1] or "__all__", (row[2] or "unknown") if extra else None)
    for row in rows:
        for at, extra, f in columns:
            if row[at] is not None:
                ds, g = key(row, extra)
                groups[f.measure, ds, g].append(row[at])
                groups[f.measure, None, g].append(row[at])
    cuts = {k: [round(percentile(v, q), 4) for q in S.PERCENTILES] for k, v in groups.items() if len(v) >= saved_min}
    for row in rows:
        got = [row[0]]
        for at, extra, f in columns:
            ds, g = key(row, extra)
            c = cuts.get((f.measure, ds, g)) or cuts.get((f.measure, None, g))
            got.append(None if row[at] is None or not c else f.values[0] if row[at] <= c[0] else f.values[1] if row[at] <= c[1] else f.values[2])
        out.append(tuple(got))
    return out


def test_calibration(spark):
    rows = records()
    df = spark.createDataFrame(rows, RECORD)
    fitted = calibration.fit(df)
    got = calibration.apply_labels(df, fitted).select("id", "pitch_level", "energy_level", "speed_level").collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == label(rows)
    again = calibration.from_document(spark, json.loads(json.dumps(calibration.as_document(fitted))))
    assert sorted(map(tuple, calibration.apply_labels(df, again).select("id", "pitch_level", "energy_level", "speed_level").collect())) == sorted(map(tuple, got))


def test_small_groups(spark):
    fit = lambda n: calibration.fit(spark.createDataFrame([(i, "a", None, None, float(i + 1), None) for i in range(n)], RECORD)).collect()
    assert sorted((r.tier, r.n, r.cuts) for r in fit(50)) == [("group", 50, [17.3333, 33.6667]), ("pooled", 50, [17.3333, 33.6667])]
    assert [(r.tier, r.n, r.cuts) for r in fit(49)] == [("group", 49, None)]
    assert fit(0) == []
    with pytest.raises(ValueError):
        calibration.fit(spark.createDataFrame([], RECORD), percentiles=(60, 30))


def test_calibration_invariances(spark):
    rows = records(300)

    def levels(rows):
        df = spark.createDataFrame(rows, RECORD)
        return {r.id: r.energy_level for r in calibration.apply_labels(df, calibration.fit(df)).collect()}

    want = levels(rows)
    assert levels(rows[::-1]) == want
    assert levels([(*r[:4], r[4] + 8, r[5]) for r in rows]) == want


def test_report(spark):
    df = spark.createDataFrame([(None, 100.0, 1.0, False), (None, None, None, None), ("Male", 90.0, 3.0, True)], "gender string, f0_median_hz double, f0_range_st double, f0_reliable boolean")
    got = report.as_document(df)
    assert got["labels"]["gender"] == {"None": 2, "Male": 1} and (got["n_records"], got["n_f0_unreliable"]) == (3, 1)
    assert got["f0_range_st"]["p50"] == 2.0 and got["f0_by_gender"]["None"]["n"] == 1
    assert any(line.startswith("gender: Male=1, None=2") for line in report.as_lines(got))


def tone(f_start, f_end=None, seconds=1.5):
    n = int(seconds * S.SAMPLE_RATE)
    phase = 2 * np.pi * np.cumsum(np.linspace(f_start, f_end or f_start, n)) / S.SAMPLE_RATE
    x = sum(0.85**k * np.sin((k + 1) * phase) for k in range(20) if (k + 1) * max(f_start, f_end or 0) < 7500)
    return 0.3 * x / np.abs(x).max()


def save(path, x, channels=1, rate=S.SAMPLE_RATE):
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.repeat((x * 32767).astype("<i2"), channels).tobytes())


@pytest.mark.parametrize("f", [80, 95, 130, 220, 330])
def test_pitch(f):
    got = pitch.pitch(tone(f))
    assert np.nanmedian(got) == pytest.approx(f, rel=0.02) and np.isfinite(got).mean() > 0.9


def test_pitch_of_little_or_nothing():
    assert len(pitch.pitch(np.zeros(1000))) == 7 and np.isnan(pitch.pitch(np.zeros(1000))).all()
    assert np.isnan(pitch.pitch(np.zeros(32000))).all()
    jump = np.array([100.0] * 10 + [200.0] * 2 + [100.0] * 10)
    assert np.allclose(pitch.repair_local(jump), 100) and len(pitch.repair_global(np.array([np.nan, 100]))) == 2


def test_audio(tmp_path):
    for channels, rate in ((1, 16000), (2, 16000), (1, 8000), (2, 44100)):
        n = int(rate * 1.5)
        x = 0.3 * np.sin(2 * np.pi * 150 * np.arange(n) / rate)
        save(tmp_path / "x.wav", x, channels, rate)
        y = audio.decode((tmp_path / "x.wav").read_bytes())
        assert len(y) == pytest.approx(24000, abs=2) and abs(y.mean()) < 1e-4 and np.abs(y).max() == pytest.approx(0.3, abs=0.02)


def test_labelling_job(spark, tmp_path):
    save(tmp_path / "rise.wav", tone(110, 180))
    save(tmp_path / "fall.wav", tone(180, 110), channels=2)
    save(tmp_path / "flat.wav", tone(120))
    save(tmp_path / "none.wav", np.zeros(32000))
    (tmp_path / "bad.wav").write_bytes(b"no audio")
    names = ["rise", "fall", "flat", "none", "bad", "missing", "no folder/x"]
    lines = [{"audio_path": str(tmp_path / f"{n}.wav"), "text": "the quick brown fox", "dataset": "d", "extra": i} for i, n in enumerate(names)]
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, [*lines, {"text": "no path", "extra": 9}])) + "\n\n")
    out = str(tmp_path / "out")
    document = labelling.run(spark, str(tmp_path / "in.jsonl"), out, min_group=2)
    got = {Path(r.audio_path).stem: r for r in jsonl.read(spark, out).collect()}
    assert set(got) == {"rise", "fall", "flat", "none"}
    assert [got[n].intonation for n in ("rise", "fall", "flat", "none")] == ["rising", "falling", "flat", "too_short"]
    assert got["flat"].f0_median_hz == pytest.approx(120, rel=0.02) and got["none"].f0_median_hz is None and got["flat"].extra == 2
    assert got["flat"].duration_s == 1.5 and got["flat"].n_phonemes > 8
    failed = {r.audio_path and Path(r.audio_path).stem: r.error for r in jsonl.read(spark, f"{out}.features.errors").collect()}
    assert set(failed) == {"bad", "missing", "x", None} and "FileNotFoundError" in failed["x"] and "FileNotFoundError" in failed["missing"]
    assert not Path(f"{out}.features.scratch").exists()
    assert document["report"]["labels"]["intonation"]["rising"] == 1 and Path(f"{out}.thresholds.json").exists()
    relabelled = labelling.run(spark, "unused", f"{out}2", "calibrate", features=f"{out}.features", min_group=2)
    assert relabelled["report"] == document["report"]


def speaker(device):
    return lambda samples: (0.3, [0.9, 0.1, 0.0] if len(samples) > 20000 else [0.1, 0.9, 0.0])


def stress(device, folder):
    def call(samples, text):
        if text == "fails":
            raise RuntimeError("no stress")
        return text.split(), [0] * (len(text.split()) - 1) + [1], 99

    return call


def test_models_of_the_job(spark, tmp_path):
    save(tmp_path / "long.wav", tone(120))
    save(tmp_path / "short.wav", tone(200, seconds=1))
    records = [("long", "one two"), ("long", "fails"), ("short", "three four"), ("short", "three four"), ("gone", "five")]
    lines = [{"audio_path": str(tmp_path / f"{n}.wav"), "text": t, "gender": "given", "odd key": {"n": [1, "é"]}, "id": i} for i, (n, t) in enumerate(records)]
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, lines)))
    out = str(tmp_path / "out")
    assert cli.main(["label", str(tmp_path / "in.jsonl"), out, "--speaker-model", "tests.test_jobs:speaker", "--stress-model", "tests.test_jobs:stress", "--min-group-size", "1"]) == 0
    got = {r["id"]: r for r in (json.loads(x.value) for x in spark.read.text(out).collect())}
    assert set(got) == {0, 2, 3} and all(r["odd key"] == {"n": [1, "é"]} and list(r)[:5] == ["audio_path", "text", "gender", "odd key", "id"] for r in got.values())
    assert (got[0]["gender"], got[2]["gender"], got[0]["age_level"], got[0]["age_years"]) == ("Female", "Male", "Young Adult", 30.0)
    assert got[0]["stressed_words"] == ["one"] and got[3]["stress_truncated"] is False and got[0]["pitch_level"] == "low"
    errors = Path(f"{out}.features.errors")
    assert sorted(r.error.split(":")[0] for r in jsonl.read(spark, str(errors)).collect()) == ["FileNotFoundError", "RuntimeError"]
    assert cli.main(["label", str(tmp_path / "in.jsonl"), out, "--limit", "1", "--skip-models", "--speaker-model", "tests.test_jobs:speaker"]) == 0
    (only,) = [json.loads(x.value) for x in spark.read.text(out).collect()]
    assert only["id"] == 0 and only["gender"] == "given" and "age_years" not in only and not errors.exists()


def test_first_rows_in_order(spark, tmp_path):
    for name in ("b", "a"):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(f'{{"n": "{name}{i:03}"}}' for i in range(300 if name == "b" else 40)))
    assert [r.n for r in jsonl.read(spark, str(tmp_path), limit=42).collect()] == [f"a{i:03}" for i in range(40)] + ["b000", "b001"]
    assert jsonl.read_open(spark, str(tmp_path), {"n": "string"}, 41).where("n = 'b000'").count() == 1
    assert jsonl.read(spark, str(tmp_path), limit=0).count() == 340


def test_stopped_enrichment(spark, tmp_path):
    df = spark.createDataFrame([(f"a{i}", "sad", f"words {i}") for i in range(12)], "audio_path string, emotion string, text string")
    out, calls = str(tmp_path / "out"), tmp_path / "calls"
    calls.mkdir()

    def counting():
        def call(prompt):
            (calls / f"{len(list(calls.iterdir()))}-{hash(prompt)}").touch()
            return "told"

        return call

    append = jsonl.append
    done = []

    def stops(df, path):
        if len(done) == 1:
            raise KeyboardInterrupt
        append(df, path)
        done.append(path)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(jsonl, "append", stops)
        with pytest.raises(KeyboardInterrupt):
            enriching.run(spark, df, out, counting, workers=1, chunk=4)
    paid = len(list(calls.iterdir()))
    assert 0 < jsonl.read(spark, out).count() < paid < 12
    assert enriching.run(spark, df, out, counting, workers=1, chunk=4, errors=str(tmp_path / "e")) == 0
    assert sorted(r.audio_path for r in jsonl.read(spark, out).collect()) == sorted(f"a{i}" for i in range(12))
    assert len(list(calls.iterdir())) == 12 and not (tmp_path / "e").exists() and not Path(f"{out}.scratch").exists()


def test_enriching_job(spark, tmp_path):
    rows = [(f"a{i}", "happy" if i % 3 else None, f"words {i}") for i in range(9)]
    df = spark.createDataFrame(rows, "audio_path string, emotion string, text string")
    out = str(tmp_path / "out")
    assert enriching.run(spark, df.limit(4), out, lambda: echo()) == 2
    assert enriching.run(spark, df, out, lambda: echo(), workers=2) == 3
    assert jsonl.read(spark, out).count() == 6 and jsonl.read(spark, f"{out}.errors").count() == 5

    def broken():
        def call(prompt):
            raise RuntimeError("no service")

        return call

    assert enriching.run(spark, df, f"{out}2", broken) == 9


def test_files(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"b": 1, "a": null, "é": "ü"}\n\n  \n{"b": 2, "new": [1, {"x": 2}]}\n', encoding="utf-8")
    df = jsonl.read_open(spark, str(tmp_path / "r.jsonl"), {"b": "int"})
    jsonl.write_open(df.withColumn("b", F.col("b") + 1).withColumn("c", F.lit(None).cast("string")), str(tmp_path / "w"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "w")).collect())
    assert lines == ['{"b": 2, "a": null, "é": "ü", "c": null}', '{"b": 3, "new": [1, {"x": 2}], "c": null}']
    (tmp_path / "bad.jsonl").write_text('{"b": 1}\n{"b": \n')
    with pytest.raises(Exception):
        jsonl.read(spark, str(tmp_path / "bad.jsonl"), "b int").collect()
    assert jsonl.done_keys(spark, str(tmp_path / "bad.jsonl"), "b int").count() == 1
    assert jsonl.done_keys(spark, str(tmp_path / "nothing"), "b int") is None


def test_stream(spark, tmp_path):
    rows = records(200)
    df = spark.createDataFrame(rows, RECORD)
    fitted = calibration.fit(df, min_group=20).cache()
    df.write.parquet(str(tmp_path / "in"))
    labels.start(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), fitted, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    got = {r.id: r.energy_level for r in jsonl.read(spark, str(tmp_path / "out")).collect()}
    assert got == {r.id: r.energy_level for r in calibration.apply_labels(df, fitted).collect()}


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "r.jsonl").write_text('{"audio_path": "a", "emotion": "sad", "text": "hi"}\n{"audio_path": "b", "text": "ho"}\n')
    assert cli.main(["enrich", str(tmp_path / "r.jsonl"), str(tmp_path / "o"), "--dry-run", "2"]) == 0
    shown = capsys.readouterr().out
    assert "sad" in shown and "[skipped] missing value: groundtruth_emotion" in shown
    assert cli.main(["enrich", str(tmp_path / "r.jsonl"), str(tmp_path / "o"), "--field", "why"]) == 1
    assert jsonl.read(spark, str(tmp_path / "o")).columns.count("why") == 1


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for path in Path(SF).iterdir():
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query(spark, db, name):
    want = db.sql(oracles.ORACLES[name])
    columns = sorted(want.columns)
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    plain = lambda rows: sorted(repr(tuple(0.0 if v == 0 and isinstance(v, float) else v for v in r)) for r in rows)
    assert plain(got.select(*columns).collect()) == plain(want.project(", ".join(columns)).fetchall())


def test_all_but_iterative_queries_have_sql():
    assert set(queries.QUERIES) - set(oracles.ORACLES) == {"octave_local"}


def test_local_octaves(spark):
    def plain(f0):
        log = [math.log2(x) for x in f0]
        for _ in range(2):
            size = min(9, len(log) - (len(log) + 1) % 2)
            pad = [log[0]] * (size // 2) + log + [log[-1]] * (size // 2)
            middle = [sorted(pad[i : i + size])[size // 2] for i in range(len(log))]
            for octave in (-1, 1):
                for i, x in enumerate(log):
                    if abs(x - middle[i]) - abs(x + octave - middle[i]) > 0.5 and math.log2(55) <= x + octave <= math.log2(500):
                        log[i] = x + octave
        return [2**x for x in log]

    r = np.random.default_rng(4)
    tracks = {u: [float(r.uniform(100, 130) * 2.0 ** r.choice([0, 0, 0, 0, 1, -1])) for _ in range(n)] for u, n in enumerate((1, 2, 3, 4, 8, 40))}
    rows = [(u, 2 * i, x, True) for u, t in tracks.items() for i, x in enumerate(t)] + [(u, 2 * i + 1, 77.0, False) for u, t in tracks.items() for i in range(len(t))]
    got = kernels.octave_local(spark.createDataFrame(rows, "utt int, frame int, f0 double, voiced boolean")).orderBy("utt", "frame").collect()
    for u, t in tracks.items():
        own = [x.f0 for x in got if x.utt == u]
        assert own[1::2] == [None] * len(t)
        assert np.allclose(own[::2], plain(t) if len(t) >= 3 else t)


def test_nothing_else_imports_the_training_data_operators():
    for path in ROOT.rglob("*.py"):
        if "llm" in path.parts or path.name in ("__spark_entry__.py", "corpus_pipeline.py"):
            continue
        for node in ast.walk(ast.parse(path.read_text(encoding="utf-8"))):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith("lilt.llm") for n in names), path
