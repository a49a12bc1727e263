"""Interfaces to external models. Each is a factory that a task calls once; the functions here are offline stand-ins."""

from __future__ import annotations

import importlib
import traceback
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lilt import schema as S
from lilt.functions.scalar import age_level, argmax_label, paired_stress, stressed_words


class SpeakerModel(Protocol):
    """Samples at 16 kHz to (age as a share of 100 years, probabilities of Female, Male, Child)."""

    def __call__(self, samples: np.ndarray) -> tuple[float, Sequence[float]]: ...


class StressModel(Protocol):
    """Samples and text to (tokens, 0/1 predictions, the most tokens it takes)."""

    def __call__(self, samples: np.ndarray, text: str) -> tuple[Sequence[str], Sequence[int], int]: ...


def _speaker(model: SpeakerModel, samples: np.ndarray | None) -> tuple:
    """(years, probabilities); nulls for empty audio. At most the first 15 seconds go to the model."""
    if samples is None or not len(samples):
        return None, None
    age, probabilities = model(np.asarray(samples, np.float32)[: int(S.SPEAKER_SECONDS * S.SAMPLE_RATE)])
    return float(np.clip(age, 0, 1)) * S.AGE_SCALE, [float(p) for p in probabilities]


def _stress(model: StressModel, samples: np.ndarray | None, text: str | None) -> tuple:
    """(tokens, flags, truncated); nulls for blank text or empty audio. The model takes peak-normalised samples."""
    if samples is None or not len(samples) or not text or not text.strip():
        return None, None, None
    x = np.asarray(samples, np.float32)
    peak = float(np.abs(x).max())
    tokens, flags, most = model(x / peak if peak > 0 else x, text)
    return list(tokens), [int(f) for f in flags], len(tokens) >= most


#: Raw answers of the models, and the columns made from them.
SPEAKER_RAW, STRESS_RAW = "_years double, _p array<double>", "_t array<string>, _f array<int>, stress_truncated boolean"
SPEAKER_COLUMNS = ("gender", "gender_confidence", "gender_probs", "age_years", "age_level")
STRESS_COLUMNS = ("stressed_words", "stress_pairs", "stress_truncated")


def _with_speaker(told: DataFrame) -> DataFrame:
    labels: Column = F.map_from_arrays(F.array(*[F.lit(g) for g in S.GENDERS]), F.transform("_p", lambda x: F.round(x, 3)))
    return told.withColumns({
        "gender": argmax_label(F.col("_p")),
        "gender_confidence": F.round(F.array_max("_p"), 3),
        "gender_probs": F.when(F.col("_p").isNotNull(), labels),
        "age_years": F.round("_years", 1),
        "age_level": age_level(F.col("_years")),
    }).drop("_years", "_p")


def _with_stress(told: DataFrame) -> DataFrame:
    pairs = F.when(F.col("_t").isNotNull(), paired_stress(F.col("_t"), F.col("_f")))
    return told.withColumn("stress_pairs", pairs).withColumn("stressed_words", stressed_words(F.col("stress_pairs"))).drop("_t", "_f")


def speaker_attributes(decoded: DataFrame, provider: Callable[[], SpeakerModel]) -> DataFrame:
    """(audio_path, gender, gender_confidence, gender_probs, age_years, age_level) from (audio_path, samples); empty audio gives nulls."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = provider()
        for batch in batches:
            rows = [(path, *_speaker(model, samples)) for path, samples in zip(batch["audio_path"], batch["samples"], strict=True)]
            yield pd.DataFrame(rows, columns=["audio_path", "_years", "_p"])

    return _with_speaker(decoded.select("audio_path", "samples").mapInPandas(run, f"audio_path string, {SPEAKER_RAW}"))


def word_stress(decoded: DataFrame, provider: Callable[[], StressModel]) -> DataFrame:
    """(audio_path, stressed_words, stress_pairs, stress_truncated) from (audio_path, samples, text); nulls for blank text or empty audio."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = provider()
        for batch in batches:
            rows = [(path, *_stress(model, samples, text)) for path, samples, text in zip(batch["audio_path"], batch["samples"], batch["text"], strict=True)]
            yield pd.DataFrame(rows, columns=["audio_path", "_t", "_f", "stress_truncated"])

    return _with_stress(decoded.select("audio_path", "samples", "text").mapInPandas(run, f"audio_path string, {STRESS_RAW}"))


def annotate(clips: DataFrame, load: Callable[[str], np.ndarray], speaker: Callable[[], SpeakerModel] | None, stress: Callable[[], StressModel] | None) -> DataFrame:
    """(audio_path, text, _failed) and the columns of the models given, from (audio_path, text).

    A task makes each model once and decodes a clip once for both; samples never leave it. A clip on which a model fails has
    the error in ``_failed`` and nulls.
    """
    nothing = ((None,) * 2, (None,) * 3)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = (speaker() if speaker else None, stress() if stress else None)
        for batch in batches:
            for path, text in zip(batch["audio_path"], batch["text"], strict=True):
                error, (who, how) = None, nothing
                try:
                    samples = load(path)
                    who = _speaker(models[0], samples) if speaker else who
                    how = _stress(models[1], samples, text) if stress else how
                except Exception:  # a failed clip is a failed record, not a failed job
                    error, (who, how) = traceback.format_exc(limit=3), nothing
                yield pd.DataFrame([(path, text, error, *who, *how)], columns=["audio_path", "text", "_failed", "_years", "_p", "_t", "_f", "stress_truncated"])

    told = _with_stress(_with_speaker(clips.select("audio_path", "text").mapInPandas(run, f"audio_path string, text string, _failed string, {SPEAKER_RAW}, {STRESS_RAW}")))
    return told.select("audio_path", "text", "_failed", *(SPEAKER_COLUMNS if speaker else ()), *(STRESS_COLUMNS if stress else ()))


def named_factory(name: str, **options) -> Callable:
    """The factory ``module:function`` with its options bound, such as a device or a checkpoint's folder; loaded in the task."""
    module, _, function = name.partition(":")
    if not function:
        raise ValueError(f"a factory is named module:function, not {name}")

    def make():
        return getattr(importlib.import_module(module), function)(**options)

    return make


def checked_weights(found: Iterable[str], needed: Iterable[str], heads: Sequence[str]) -> None:
    """Raises if a checkpoint lacks parameters whose names start with one of heads: a model must not predict from random weights."""
    have = set(found)
    lacking = [n for n in needed if n.startswith(tuple(heads)) and n not in have]
    if lacking:
        raise RuntimeError(f"the checkpoint lacks {len(lacking)} parameters, the first of them {', '.join(lacking[:5])}")


def echo() -> Callable[[str], str]:
    """An offline text provider: says how long its prompt is."""
    return lambda prompt: f"{len(prompt)} characters"


def chat(base_url: str, model: str, api_key: str, temperature: float = 1.0, max_tokens: int = 512, retries: int = 5, timeout: float = 60.0) -> Callable[[], Callable[[str], str]]:
    """A provider for chat-completion services with an HTTP interface."""

    def make() -> Callable[[str], str]:
        import json
        import time
        import urllib.request

        def call(prompt: str) -> str:
            body = json.dumps({"model": model, "temperature": temperature, "max_tokens": max_tokens, "messages": [{"role": "user", "content": prompt}]}).encode()
            request = urllib.request.Request(f"{base_url.rstrip('/')}/chat/completions", body, {"Content-Type": "application/json", "Authorization": f"Bearer {api_key}"})
            for attempt in range(retries + 1):
                try:
                    with urllib.request.urlopen(request, timeout=timeout) as answer:
                        return json.load(answer)["choices"][0]["message"]["content"]
                except OSError:
                    if attempt == retries:
                        raise
                    time.sleep(min(30.0, 2.0**attempt))
            raise AssertionError

        return call

    return make


#: Fixed value: answers that a single-clip emotion request offers.
EMOTIONS = ("neutral", "happy", "sad", "angry", "contempt or disgust", "confused", "whisper", "surprise", "fear")


def clip_request(audio: Column) -> Column:
    """Chat messages that ask for the emotion of one clip, reasoning and answer in tags. array<struct<role, content>>."""
    ask = "Which emotion does the speaker express? Choose from: " + ", ".join(EMOTIONS) + ". Reason in <think></think>, then answer in <answer></answer>."
    part = lambda kind, text, clip: F.struct(F.lit(kind).alias("type"), text.cast("string").alias("text"), clip.cast("string").alias("audio"))
    content = F.array(part("audio", F.lit(None), audio), part("text", F.lit(ask), F.lit(None)))
    return F.array(F.struct(F.lit("user").alias("role"), content.alias("content")))


def tagged(answer: Column, tag: str) -> Column:
    """Text between a pair of tags; null if there is none."""
    found = F.regexp_extract(answer, rf"(?s)<{tag}>(.*?)</{tag}>", 1)
    return F.nullif(F.trim(found), F.lit(""))


def clip_answers(clips: DataFrame, provider: Callable[[], Callable[[list], str]]) -> DataFrame:
    """clips (audio_path) with ``answer``, ``thinking``, ``emotion`` and ``_error``: one request for each clip, made in the task.

    provider makes, once a task, a function from chat messages to an answer; what it raises is the row's error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = provider()
        for batch in batches:
            for path, messages in zip(batch["audio_path"], batch["_m"], strict=True):
                answer = error = None
                try:
                    answer = call([{"role": m["role"], "content": [{k: v for k, v in p.items() if v is not None} for p in m["content"]]} for m in messages])
                except Exception as e:  # a failed request is a failed record, not a failed job
                    error = f"{type(e).__name__}: {e}"
                yield pd.DataFrame([(path, answer, error)], columns=["audio_path", "answer", "_error"])

    asked = clips.select("audio_path", clip_request(F.col("audio_path")).alias("_m"))
    told = asked.mapInPandas(run, "audio_path string, answer string, _error string")
    return told.select("audio_path", "answer", tagged(F.col("answer"), "think").alias("thinking"), tagged(F.col("answer"), "answer").alias("emotion"), "_error")
