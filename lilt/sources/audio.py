"""Audio: WAV decoding, resampling, and the measuring kernel that turns files into frame tracks."""

from __future__ import annotations

import io
import traceback
import wave
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow.fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lilt import schema as S
from lilt.functions import pitch

TRACK = "audio_path string, n_samples long, rms array<double>, f0 array<double>, _error string"


def decode(data: bytes) -> np.ndarray:
    """Mono float samples at 16 kHz with mean 0 of a PCM WAV file; channels are averaged."""
    with wave.open(io.BytesIO(data)) as w:
        width, channels, rate, raw = w.getsampwidth(), w.getnchannels(), w.getframerate(), w.readframes(w.getnframes())
    if width == 1:
        x = np.frombuffer(raw, np.uint8).astype(np.float32) / 128 - 1
    elif width == 3:
        parts = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((parts[:, 0] << 8 | parts[:, 1] << 16 | parts[:, 2] << 24) >> 8).astype(np.float32) / (1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{width}").astype(np.float32) / (1 << (8 * width - 1))
    y = resample(x.reshape(-1, channels).mean(axis=1), rate)
    return y - y.mean() if len(y) else y


def resample(x: np.ndarray, rate: int) -> np.ndarray:
    """Band-limited resampling to 16 kHz through the spectrum."""
    if rate == S.SAMPLE_RATE or not len(x):
        return x
    n = int(round(len(x) * S.SAMPLE_RATE / rate))
    spectrum = np.fft.rfft(x)
    out = np.zeros(n // 2 + 1, complex)
    m = min(len(spectrum), len(out))
    out[:m] = spectrum[:m]
    return (np.fft.irfft(out, n) * n / len(x)).astype(np.float32)


def files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths and contents of the .wav, .flac and .mp3 files of a folder, in path order."""
    found = spark.read.format("binaryFile").load(folder).where(F.col("path").rlike(r"(?i)\.(wav|flac|mp3)$"))
    return found.select("path", "content").orderBy("path")


def load(path: str) -> bytes:
    """A file's contents, read by the task that needs them: plain and file: paths directly, other schemes through Arrow's file systems."""
    if "://" in path and not path.startswith("file:"):
        system, inner = pa_fs.FileSystem.from_uri(path)
        with system.open_input_stream(inner) as f:
            return f.read()
    with open(unquote(urlparse(path).path) if path.startswith("file:") else path, "rb") as f:
        return f.read()


def measure(clips: DataFrame, load: Callable[[str], bytes] = load) -> DataFrame:
    """TRACK rows from audio_path; a file that is missing or can't be decoded has an error instead of tracks.

    Paths are dealt to tasks, not contents: audio crosses no exchange, and a task holds one recording at a time.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["audio_path"]:
                try:
                    y = decode(load(path))
                    f0 = pitch.pitch(y)
                    row = (path, len(y), pitch.amplitude(y).tolist(), [None if np.isnan(x) else float(x) for x in f0], None)
                except Exception:  # a bad file is a failed record, not a failed job
                    row = (path, None, None, None, traceback.format_exc(limit=3))
                yield pd.DataFrame([row], columns=["audio_path", "n_samples", "rms", "f0", "_error"])

    return clips.select("audio_path").mapInPandas(run, TRACK)


def to_frames(measured: DataFrame) -> DataFrame:
    """(utt, frame, rms, f0, voiced) from measured rows without an error."""
    rows = measured.where(F.col("_error").isNull()).select(F.col("audio_path").alias("utt"), F.posexplode(F.arrays_zip("rms", "f0")).alias("frame", "v"))
    return rows.select("utt", "frame", "v.rms", "v.f0", F.col("v.f0").isNotNull().alias("voiced"))
