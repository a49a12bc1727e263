"""The enrichment job: prompts for records not done yet, generated texts appended chunk by chunk."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lilt.operators import augment
from lilt.sources import jsonl

#: Records of a chunk, the most whose calls a stopped driver can lose.
CHUNK = 2_000
KEY = T.StructType([T.StructField("_key", T.StringType())])


def deliver(spark: SparkSession, staged: str, output: str) -> None:
    """Appends the texts of a chunk that an earlier run generated and then didn't append."""
    left = spark.read.parquet(staged).where(F.col("_error").isNull()).drop("_prompt", "_error")
    jsonl.append(augment.pending(left, jsonl.done_keys(spark, output, KEY)), output)


def run(
    spark: SparkSession, records: DataFrame, output: str, provider: Callable[[], Callable[[str], str]], field: str = "reasoning", resume: bool = True, workers: int = 8,
    template: str = augment.TEMPLATE, errors: str | None = None, chunk: int = CHUNK,
) -> int:
    """Appends enriched records to output and failures to errors (output.errors); returns the number of failures.

    With resume, records whose key an earlier run wrote are skipped; without, output may hold them twice. Pending records are
    dealt to chunks by a hash of their key. A chunk's answers are written once, under output.scratch, before they are appended,
    so a stopped run loses at most the chunk it was at, and the next one first appends what was left there. The number of
    partitions of a chunk, workers, bounds the calls at a time.
    """
    errors, scratch = errors or f"{output}.errors", f"{output}.scratch"
    prompts, answers = f"{scratch}/prompts", f"{scratch}/answers"
    if jsonl.exists(spark, f"{answers}/_SUCCESS"):
        deliver(spark, answers, output)
    jsonl.delete(spark, scratch)
    done = jsonl.done_keys(spark, output, KEY) if resume else None
    pending = augment.pending(augment.keyed(records), done)
    chunks = max(1, -(-pending.count() // chunk))
    prompted = augment.prompts(pending, template).withColumn("_chunk", F.pmod(F.xxhash64("_key"), F.lit(chunks)))
    prompted.repartition(min(chunks, 200), "_chunk").write.partitionBy("_chunk").parquet(prompts)
    columns = prompted.drop("_chunk").schema
    failures = 0
    for i in range(chunks):
        part = f"{prompts}/_chunk={i}"
        if not jsonl.exists(spark, part):
            continue
        dealt = spark.read.schema(columns).parquet(part).repartition(workers)
        generated = jsonl.settled(augment.generate(dealt, provider, field), answers)
        failed = generated.where(F.col("_error").isNotNull()).select("_key", F.col("_error").alias("error"))
        n = failed.count()
        if n:
            jsonl.append(failed, errors)
        jsonl.append(generated.where(F.col("_error").isNull()).drop("_prompt", "_error"), output)
        jsonl.delete(spark, answers)
        failures += n
    jsonl.delete(spark, scratch)
    return failures
