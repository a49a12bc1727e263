"""Column functions: text, labels, rates. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lilt import schema as S


def truthy(column: Column) -> Column:
    """The column as text, null where it is null or empty."""
    return F.nullif(column.cast("string"), F.lit(""))


def first_text(df: DataFrame, fields: Sequence[str] = ("transcription", "text", "transcript")) -> Column:
    """First non-empty field that df has; the empty text if none."""
    return F.coalesce(*[truthy(F.col(f)) for f in fields if f in df.columns], F.lit(""))


def given(df: DataFrame, field: str) -> Column:
    """A field as text, null if null, an empty text or an empty list; lists are joined by a comma and a blank."""
    kind = df.schema[field].dataType
    if isinstance(kind, T.ArrayType):
        return F.when(F.size(field) > 0, F.array_join(F.col(field).cast("array<string>"), ", ", "None"))
    if isinstance(kind, T.BooleanType):
        return F.initcap(F.col(field).cast("string"))
    return truthy(F.col(field))


def placeholders(df: DataFrame, aliases: Mapping[str, Sequence[str]] = S.ALIASES) -> dict[str, Column]:
    """For each prompt placeholder the first given field, or its default; required ones are null where missing."""
    out = {}
    for name, fields in aliases.items():
        found = [given(df, f) for f in fields if f in df.columns]
        missing = F.lit(None).cast("string") if name in S.REQUIRED else F.lit(S.DEFAULTS.get(name, S.UNKNOWN))
        out[name] = F.coalesce(*found, missing)
    return out


def fill(template: str, values: Mapping[str, Column]) -> Column:
    """A template with {name} placeholders filled in one pass: braces inside values stay as they are."""
    parts, rest = [], template
    while rest:
        at = min(((rest.find("{" + n + "}"), n) for n in values if "{" + n + "}" in rest), default=None)
        if at is None:
            parts.append(F.lit(rest))
            break
        if at[0]:
            parts.append(F.lit(rest[: at[0]]))
        parts.append(values[at[1]])
        rest = rest[at[0] + len(at[1]) + 2 :]
    return F.concat(*parts) if parts else F.lit("")


def record_key(df: DataFrame, index: Column) -> Column:
    """audio_path, else id (0 doesn't count), else # and the index."""
    options = [truthy(F.col("audio_path"))] if "audio_path" in df.columns else []
    if "id" in df.columns:
        number = isinstance(df.schema["id"].dataType, T.NumericType)
        options.append(F.when(F.col("id") != 0, F.col("id").cast("string")) if number else truthy(F.col("id")))
    return F.coalesce(*options, F.concat(F.lit("#"), index.cast("string")))


def group_key(column: Column, missing: str) -> Column:
    """A grouping value as text; missing where null or empty."""
    return F.coalesce(truthy(column), F.lit(missing))


def three_way(value: Column, low: Column, high: Column, labels: Sequence[str]) -> Column:
    """labels[0] up to the low cut, labels[1] up to the high one, else labels[2]; null without a value or cuts."""
    labelled = F.when(value <= low, labels[0]).when(value <= high, labels[1]).otherwise(labels[2])
    return F.when(value.isNotNull() & low.isNotNull() & high.isNotNull(), labelled)


def age_level(years: Column) -> Column:
    """Age group of half-open ranges; null for null."""
    out = F.when(years.isNull(), F.lit(None).cast("string"))
    for bound, label in S.AGE_LEVELS[:-1]:
        out = out.when(years < bound, label)
    return out.otherwise(S.AGE_LEVELS[-1][1])


def argmax_label(probabilities: Column, labels: Sequence[str] = S.GENDERS) -> Column:
    """Label of the first greatest probability; null for null or empty."""
    at = F.array_position(probabilities, F.array_max(probabilities)).cast("int")
    return F.when(at > 0, F.element_at(F.array(*map(F.lit, labels)), at))


def rates(n: Column, total_s: Column, speech_s: Column) -> dict[str, Column]:
    """Phones a second of all and of speaking time, 3 places; null without phones or time."""
    rate = lambda s: F.when((n > 0) & (s > 0), F.round(n / s, 3))
    return {"speaking_rate_pps": rate(total_s), "articulation_rate_pps": rate(speech_s)}


def non_latin(text: Column) -> Column:
    """Whether a text has kana, CJK or Hangul, for which phones aren't counted."""
    return text.rlike("[぀-ヿ㐀-䶿一-鿿가-힯]")


def arpabet(tokens: Column) -> Column:
    """The phone tokens of a list: one to three capitals, maybe a stress digit."""
    return F.filter(tokens, lambda x: x.rlike("^[A-Z]{1,3}[0-2]?$"))


def failure_reason(error: Column) -> Column:
    """Last line of an error text, first 120 characters."""
    return F.substring(F.element_at(F.split(F.btrim(error, F.lit(" \t\n\x0b\x0c\r")), "\n"), -1), 1, 120)


def paired_stress(tokens: Column, flags: Column) -> Column:
    """Tokens with the predictions rotated right by one; empty words dropped. array<struct<word, flag>>."""
    rotated = F.concat(F.slice(flags, -1, 1), F.slice(flags, F.lit(1), F.greatest(F.size(flags) - 1, F.lit(0))))
    pairs = F.transform(F.arrays_zip(tokens.alias("w"), rotated.alias("f")), lambda p: F.struct(p["w"].alias("word"), p["f"].cast("int").alias("flag")))
    return F.filter(pairs, lambda p: p["word"] != "")


def stressed_words(pairs: Column) -> Column:
    """The words flagged 1."""
    return F.transform(F.filter(pairs, lambda p: p["flag"] == 1), lambda p: p["word"])


def peak_normalised(samples: Column) -> Column:
    """Samples divided by their greatest magnitude; as they are if that is 0."""
    peak = F.array_max(F.transform(samples, F.abs))
    return F.when(peak > 0, F.transform(samples, lambda x: x / peak)).otherwise(samples)
