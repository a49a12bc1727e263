"""JSON Lines: records in, records out, resumable appends."""

from __future__ import annotations

import json
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, path: str, schema: T.StructType | str | None = None, limit: int | None = None) -> DataFrame:
    """Records of a file or folder; blank lines are skipped, a malformed line fails the job. limit takes the first ones."""
    reader = spark.read.option("mode", "FAILFAST")
    return first((reader.schema(schema) if schema else reader).json(path), limit)


def first(df: DataFrame, n: int | None) -> DataFrame:
    """The first n rows of files in the order of their paths and lines; all of them for 0 or None. Every task keeps at most n."""
    if not n:
        return df
    marked = df.select("*", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("_place"))
    return marked.orderBy("_place").limit(n).drop("_place")


def read_open(spark: SparkSession, path: str, fields: dict[str, str] | None = None, limit: int | None = None) -> DataFrame:
    """Typed columns for ``fields`` (name to type) and ``_record``, the whole line, so that unknown fields pass through.

    A field that is absent or of another type is null; no scan infers a schema.
    """
    lines = first(spark.read.text(path).where(F.trim("value") != ""), limit)
    parsed = lines.select(F.col("value").alias("_record"), F.parse_json("value").alias("_v"))
    return parsed.select("_record", *[F.try_variant_get("_v", f"$['{n}']", t).alias(n) for n, t in (fields or {}).items()])


@F.pandas_udf(T.StringType())
def _overlaid(records: pd.Series, computed: pd.Series) -> pd.Series:
    return pd.Series([json.dumps({**json.loads(r), **json.loads(c)}, ensure_ascii=False) for r, c in zip(records, computed, strict=True)])


def write_open(df: DataFrame, path: str) -> None:
    """Overwrites path with each ``_record`` overlaid by the other columns, nulls included; fields keep their order."""
    computed = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "_record"]), {"ignoreNullFields": "false"})
    df.select(_overlaid("_record", computed).alias("value")).write.mode("overwrite").text(path)


def write(df: DataFrame, path: str) -> None:
    """Overwrites path; nulls are written."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def append(df: DataFrame, path: str) -> None:
    """Adds to path; order isn't kept. Spark's committer makes a batch visible as a whole."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def _target(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file system has a path."""
    system, target = _target(spark, path)
    return system.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or folder, if it is there."""
    system, target = _target(spark, path)
    system.delete(target, True)


def settled(df: DataFrame, path: str) -> DataFrame:
    """df written as Parquet and read back: a lost executor costs reading it again, not making it again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def done_keys(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """Records written by earlier runs; None if there are none. Blank and malformed lines are skipped."""
    if not exists(spark, path):
        return None
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def write_document(document: dict, path: str) -> None:
    """A small JSON document, indented, on the driver's file system."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(document, indent=2, ensure_ascii=False) + "\n", encoding="utf-8")
