"""Column functions, worked by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lilt import schema as S
from lilt.functions import providers, scalar
from lilt.functions.phones import count_phones
from lilt.functions.rounding import py_round
from lilt.operators import augment, contour


def value(spark, column, row=(1,), schema="x int"):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()["v"]


def test_levels(spark):
    rows = spark.createDataFrame([(17.3333,), (33.6667,), (33.67,), (None,)], "v double")
    got = rows.select(scalar.three_way(F.col("v"), F.lit(17.3333), F.lit(33.6667), ("low", "normal", "high")).alias("l"))
    assert [r.l for r in got.collect()] == ["low", "normal", "high", None]


def test_ages(spark):
    rows = spark.createDataFrame([(x,) for x in (12.99, 13.0, 20.0, 35.0, 60.0, None)], "v double")
    got = [r.l for r in rows.select(scalar.age_level(F.col("v")).alias("l")).collect()]
    assert got == ["Child", "Teenager", "Young Adult", "Middle-aged", "Elderly", None]


def test_text_and_keys(spark):
    df = spark.createDataFrame([("", "hi", "", 7, None)], "transcription string, text string, audio_path string, id long, stressed_words array<string>")
    first = df.select(scalar.first_text(df).alias("t"), scalar.record_key(df, F.lit(3)).alias("k"), *[c.alias(n) for n, c in scalar.placeholders(df).items()]).first()
    assert (first.t, first.k, first.stressed_word, first.intonation_contour, first.groundtruth_emotion) == ("hi", "7", "unknown", "uncertain", None)
    zero = spark.createDataFrame([(0,)], "id long")
    assert zero.select(scalar.record_key(zero, F.lit(3)).alias("k")).first().k == "#3"
    listed = spark.createDataFrame([(["a", "b"],)], "stress array<string>")
    assert listed.select(scalar.placeholders(listed)["stressed_word"].alias("s")).first().s == "a, b"


def test_fill_is_one_pass(spark):
    got = value(spark, scalar.fill("say {a} and {b}, {a}", {"a": F.lit("{b}"), "b": F.lit("B")}))
    assert got == "say {b} and B, {b}"


def test_prompt_errors(spark):
    df = spark.createDataFrame([("happy", "hi"), (None, "hi"), (None, "")], "emotion string, text string")
    got = augment.prompts(df).collect()
    assert got[0]._error is None and "happy" in got[0]._prompt
    assert [r._error for r in got[1:]] == ["missing value: groundtruth_emotion", "missing value: groundtruth_emotion, transcription"]


def test_rates(spark):
    for n, total, speech, want in ((30, 4.0, 3.0, (7.5, 10.0)), (None, 4.0, 3.0, (None, None)), (30, 4.0, 0.0, (7.5, None))):
        df = spark.createDataFrame([(n, total, speech)], "n int, t double, s double")
        got = df.select(*[c.alias(k) for k, c in scalar.rates(F.col("n"), F.col("t"), F.col("s")).items()]).first()
        assert tuple(got) == want


def test_stress_rotation(spark):
    pairs = value(spark, scalar.paired_stress(F.array(*map(F.lit, ("x", "", "z"))), F.array(F.lit(1), F.lit(0), F.lit(1))))
    assert [(p.word, p.flag) for p in pairs] == [("x", 1), ("z", 0)]


def test_argmax_takes_the_first(spark):
    assert value(spark, scalar.argmax_label(F.array(F.lit(0.4), F.lit(0.4), F.lit(0.2)))) == "Female"


def test_failures(spark):
    assert value(spark, scalar.failure_reason(F.lit("Trace\n  at\nValueError: " + "x" * 200 + "\n"))) == ("ValueError: " + "x" * 200)[:120]


def test_guards(spark):
    rows = spark.createDataFrame([("漢",), ("かな",), ("한",), ("Ж é",)], "t string")
    assert [r.v for r in rows.select(scalar.non_latin(F.col("t")).alias("v")).collect()] == [True, True, True, False]
    assert count_phones("漢字") is None and count_phones(" ") is None and count_phones("...") is None
    assert 25 < count_phones("The quick brown fox jumps over the lazy dog near the river") < 50


def test_contour_decisions(spark):
    told = [
        (contour.dynamics(F.lit(x)), w) for x, w in ((2.99, "flat"), (3.0, "moderate"), (9.0, "moderate"), (9.01, "expressive"))
    ] + [
        (contour.confidence(F.lit("rising"), F.lit(3.0), F.lit(0.0), F.lit(0.8), F.lit(1)), 0.28),
        (contour.confidence(F.lit("level"), F.lit(0.5), F.lit(0.0), F.lit(2.0), F.lit(0)), 0.75),
        (contour.confidence(F.lit("insufficient_voiced"), F.lit(0.5), F.lit(0.0), F.lit(2.0), F.lit(0)), 0.0),
    ]
    for shape, dynamics, confidence, want in (("level", "moderate", 0.5, "flat"), ("level", "expressive", 0.5, "expressive"), ("rising", "flat", 0.149, "uncertain"), ("rising", "flat", 0.15, "rising"), (None, "flat", 0.9, "too_short")):
        told.append((contour.intonation(F.lit(shape).cast("string"), F.lit(dynamics), F.lit(confidence)), want))
    for column, want in told:
        assert value(spark, column) == (pytest.approx(want) if isinstance(want, float) else want)


def test_python_rounding(spark):
    rows = spark.createDataFrame([(2.675,), (1.005,), (0.125,), (None,)], "v double")
    assert [r.r for r in rows.select(py_round(2)("v").alias("r")).collect()] == [round(x, 2) for x in (2.675, 1.005, 0.125)] + [None]


def test_providers(spark):
    audio = spark.createDataFrame([("a", [0.1] * 10, "one two"), ("b", [], "x"), ("c", [0.5], " ")], "audio_path string, samples array<float>, text string")
    told = {r.audio_path: r for r in providers.speaker_attributes(audio, lambda: lambda x: (0.25, [0.1, 0.7, 0.2])).collect()}
    assert (told["a"].gender, told["a"].age_years, told["a"].age_level, told["a"].gender_probs["Male"]) == ("Male", 25.0, "Young Adult", 0.7)
    assert told["b"].gender is None and told["b"].gender_probs is None
    stress = {r.audio_path: r for r in providers.word_stress(audio, lambda: lambda x, t: (t.split(), [0, 1], 2)).collect()}
    assert stress["a"].stressed_words == ["one"] and stress["a"].stress_truncated and stress["c"].stress_pairs is None
    request = value(spark, providers.clip_request(F.lit("x.wav")))
    assert request[0].content[0].audio == "x.wav" and all(e in request[0].content[1].text for e in providers.EMOTIONS)
    assert value(spark, providers.tagged(F.lit("<think>a\nb</think><answer>sad</answer>"), "answer")) == "sad"


def test_vocabularies():
    assert set(S.INTONATIONS) >= {"rising", "too_short"} and len(S.AGE_LEVELS) == 5


def test_models_by_name_and_clips(spark):
    assert providers.named_factory("builtins:dict", device="cpu")() == {"device": "cpu"}
    providers.checked_weights(["age.w", "other"], ["age.w", "body.b"], ("age.",))
    with __import__("pytest").raises(RuntimeError, match="lacks 1 "):
        providers.checked_weights(["age.w"], ["age.w", "age.b", "body.b"], ("age.",))

    def provider():
        def call(messages):
            parts = messages[0]["content"]
            if parts[0]["audio"] == "bad":
                raise OSError("gone")
            return f"<think>{parts[0]['audio']}</think><answer>sad</answer>" if parts[1].get("text") else ""

        return call

    got = {r.audio_path: r for r in providers.clip_answers(spark.createDataFrame([("x",), ("bad",)], "audio_path string"), provider).collect()}
    assert (got["x"].thinking, got["x"].emotion, got["x"]._error) == ("x", "sad", None) and got["bad"]._error == "OSError: gone" and got["bad"].answer is None
