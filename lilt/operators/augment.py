"""Text enrichment of records: prompts, resuming, generation through a provider."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lilt import schema as S
from lilt.functions.scalar import fill, placeholders, record_key

TEMPLATE = (
    "Describe how the speaker sounds and explain why the emotion is {groundtruth_emotion}.\n"
    "Words: {transcription}\nGender: {speaker_gender}; age: {speaker_age}; pitch: {pitch_level}; loudness: {energy_level}; "
    "speed: {speed_level}; intonation: {intonation_contour}; stressed: {stressed_word}.\n"
    "End with the emotion, {groundtruth_emotion}."
)


def prompts(records: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """records with ``_prompt`` and ``_error``; a record without a required value has an error instead of a prompt."""
    values = placeholders(records)
    missing = F.concat_ws(", ", *[F.when(values[n].isNull(), F.lit(n)) for n in S.REQUIRED])
    return records.withColumn("_prompt", fill(template, values)).withColumn("_error", F.when(missing != "", F.concat(F.lit("missing value: "), missing)))


def keyed(records: DataFrame, index: Column | None = None) -> DataFrame:
    """records with ``_key``: audio_path, id, or a hash of the record's content, which unlike a position holds over runs."""
    content = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(records.columns)])))
    return records.withColumn("_key", record_key(records, content if index is None else index))


def pending(records: DataFrame, done: DataFrame | None) -> DataFrame:
    """Records whose key isn't done; repeated keys of records stay."""
    return records if done is None else records.join(done.select("_key").distinct(), "_key", "left_anti")


def dry_run(records: DataFrame, n: int = 1, template: str = TEMPLATE) -> DataFrame:
    """The first n prompts in order of ``_row``; a skipped record shows why."""
    shown = prompts(records, template).orderBy("_row").limit(n)
    return shown.select("_row", F.coalesce(F.concat(F.lit("[skipped] "), "_error"), "_prompt").alias("text"))


def generate(prompted: DataFrame, provider: Callable[[], Callable[[str], str]], field: str = "reasoning") -> DataFrame:
    """prompted with ``field`` from a provider, called for records without an error; its failures become ``_error``.

    provider is called once a task and gives the function from prompt to text. Only prompts cross to Python; the number of
    partitions bounds the calls at a time.
    """
    names = [c for c in prompted.columns if c != field]
    schema = T.StructType([prompted.schema[c] for c in names] + [T.StructField(field, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = provider()
        for batch in batches:
            texts, errors = [], []
            for prompt, error in zip(batch["_prompt"], batch["_error"], strict=True):
                text = None
                if pd.isna(error):
                    try:
                        text, error = call(prompt), None
                    except Exception as e:  # a failed call is a failed record, not a failed job
                        error = f"{type(e).__name__}: {e}"
                texts.append(text)
                errors.append(error)
            yield batch[names].assign(**{"_error": errors, field: texts})

    return prompted.mapInPandas(run, schema)
