"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word: a run of characters other than the six ASCII white-space ones.
WORD = r"[^\x20\x09-\x0D]+"
#: The six ASCII white-space characters, for trimming.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words remembered by a task before its memo is emptied, and the longest one remembered.
MEMO_WORDS, MEMO_BYTES = 150_000, 64
#: Rows that may be broadcast once they have been counted.
BROADCAST_ROWS = 1_000_000


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage, as the session names it; one of our own only in local mode (tests)."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not named and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="lilt-checkpoint-"))
    return named or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder and continues from there.

    A lost executor then costs a re-read of the written rows, not a recomputation of what led to them.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files that led to what has been cut.

    It deletes them once the driver's garbage is collected; else those of one step may still lie there in the next ones.
    """
    gc.collect()
    spark._jvm.System.gc()


def small(df: DataFrame, rows: int) -> DataFrame:
    """df, which has that many rows, marked for broadcasting if they are few; beyond that joins shuffle it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def partitions(spark: SparkSession, rows: int = 0, each: int = 1) -> int:
    """The session's number of shuffle partitions, or more so that one has about ``each`` of ``rows``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


def bounded_batches(spark: SparkSession, rows: int = 2000, mb: int = 16) -> None:
    """Lowers the session's limits of an Arrow batch handed to Python, in rows and in bytes, where they are higher.

    Plans take the limits that hold when they are started, after an operator has returned, so they stay lowered.
    """
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    name = "spark.sql.execution.arrow.{}PerBatch".format
    if not 0 < int(spark.conf.get(name("maxRecords"))) <= rows:
        spark.conf.set(name("maxRecords"), str(rows))
    if not 0 < limit(spark.conf.get(name("maxBytes"))) <= mb << 20:
        spark.conf.set(name("maxBytes"), f"{mb}m")


def give_back() -> None:
    """Returns freed memory to the machine: after a task the worker may wait long for its next one, beside others."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone. Pure ASCII takes the fast built-in, which is then the same function."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def source_key(source: Column) -> Column:
    """A text key that keeps null apart from every string and sorts it last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


class Generations:
    """A memo of two generations: what the younger one hasn't seen but the older one has moves over."""

    def __init__(self, most: int) -> None:
        self.most, self.young, self.old, self.new = most, {}, {}, []

    def lacking(self, keys: set) -> list:
        """The keys in neither generation, to be put into the younger one; the others are in the younger one afterwards."""
        old, young = self.old, self.young
        missing = keys.difference(young)
        if old:
            known = missing.intersection(old)
            young.update(zip(known, map(old.__getitem__, known), strict=True))
            missing -= known
        out = list(missing)
        self.new += out
        return out

    def trim(self, longest: int) -> None:
        """Forgets new keys that are longer, and the older generation once the younger one is full."""
        for key in self.new:
            if len(key) > longest:
                self.young.pop(key, None)
        self.new = []
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young


class WordHashes(dict):
    """word (bytes) -> 64-bit hash; short words are remembered, until trim() finds MEMO_WORDS of them.

    A task makes its own, so nothing stays in a worker that waits for its next task.
    """

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= MEMO_BYTES:
            self[word] = h
        return h

    def trim(self) -> None:
        if len(self) > MEMO_WORDS:
            self.clear()


def runs_of(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of at most ``most`` bytes of a column; a longer value is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = done = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(at, stop - at)
        at, done = stop, int(ends[stop - 1])


def append_columns(docs: DataFrame, make_kernel: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]], new: list[T.StructField], only: list[str] | None = None, runs: tuple[str, int] | None = None) -> DataFrame:
    """docs with the columns that a kernel computes from each Arrow batch.

    make_kernel runs once a task; its kernel returns one array for each field of ``new``. Columns of docs named like a
    new one are replaced. ``only`` limits what passes through (and what the scan reads). With ``runs``, a column and a
    number of bytes, the kernel gets a batch by runs of so many bytes of that column, each is returned before the next, and
    freed memory goes back to the machine after each batch.
    """
    bounded_batches(docs.sparkSession)
    names = [f.name for f in new]
    read = docs if only is None else docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys(only)])
    keep = [c for c in read.columns if c not in names]
    schema = T.StructType([read.schema[c] for c in keep] + new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = make_kernel()
        for batch in batches:
            for part in runs_of(batch, *runs) if runs else [batch]:
                if part.num_rows:
                    yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + kernel(part), names=keep + names)
            if runs:
                give_back()
        del kernel
        give_back()

    return read.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()
