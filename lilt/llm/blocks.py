"""Blocks of documents and packed hash lists: what the deduplication operators move between tasks.

A block holds the ids and texts of some documents, compressed, in one row. Hash lists of a block are sorted, so equal
hashes of a block travel once, and packed as byte planes of differences, which takes 5 to 6 bytes for a random 64-bit
hash where a row of its own takes 20 and more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lilt.llm.common import WordHashes, bounded_batches, utf8

BLOCK_SCHEMA = "block long, n_docs long, n_bytes long, docs binary"
#: Odd multiplier of the rolling hash and the constants that spread its bits.
MULTIPLIER, SPREAD = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def pack_planes(values: np.ndarray) -> bytes:
    """Compresses unsigned 64-bit integers as byte planes."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_planes(packed: bytes) -> np.ndarray:
    """The integers of pack_planes()."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    """Compresses ascending unsigned 64-bit integers by their differences."""
    return pack_planes(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    """The integers of pack_sorted()."""
    return np.cumsum(unpack_planes(packed), dtype=np.uint64)


def make_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8 << 20, block_docs: int = 8192) -> DataFrame:
    """Rows (block, n_docs, n_bytes, docs) of at most block_docs documents and about block_bytes of text each.

    A longer text is a block of its own. Write the result with cut() before using it twice: ids of blocks hold for one run.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        texts: list[bytes | None] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal made, size
            lengths = np.array([-1 if t is None else len(t) for t in texts], "<i8")
            given = np.array([i is not None for i in ids], np.uint8)
            head = np.array([len(ids)], "<i8").tobytes() + np.array([i or 0 for i in ids], "<i8").tobytes() + given.tobytes() + lengths.tobytes()
            packed = zstandard.ZstdCompressor(level=1).compress(head + b"".join(t for t in texts if t))
            row = [pa.array([made], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([size], pa.int64()), pa.array([packed], pa.binary())]
            made += 1
            ids.clear()
            texts.clear()
            size = 0
            return pa.RecordBatch.from_arrays(row, names=["block", "n_docs", "n_bytes", "docs"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                if ids and (size + len(t or b"") > block_bytes or len(ids) >= block_docs):
                    yield flush()
                ids.append(i)
                texts.append(t)
                size += len(t or b"")
        if ids:
            yield flush()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, BLOCK_SCHEMA)


def open_block(packed: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
    """ids, whether each is given, and texts of a block, in ascending order of id (null ids first)."""
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    ids, given = np.frombuffer(raw, "<i8", n, 8), np.frombuffer(raw, np.uint8, n, 8 + 8 * n).astype(bool)
    lengths = np.frombuffer(raw, "<i8", n, 8 + 9 * n)
    ends = np.cumsum(np.maximum(lengths, 0)) + 8 + 17 * n
    texts = [None if m < 0 else raw[e - m : e] for m, e in zip(lengths.tolist(), ends.tolist(), strict=True)]
    order = np.lexsort((ids, given))
    return ids[order], given[order], [texts[i] for i in order]


def word_hashes(words: list[bytes], memo: WordHashes) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hashes (polynomials mod 2 ** 64, bits spread afterwards) of the n words from each place on."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for j in range(n):
        h *= np.uint64(MULTIPLIER)
        h += words[j : j + m]
    return spread(h)


def spread(h: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of the bits of 64-bit integers."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(SPREAD[0])
    h ^= h >> np.uint64(27)
    h *= np.uint64(SPREAD[1])
    return h ^ (h >> np.uint64(31))
