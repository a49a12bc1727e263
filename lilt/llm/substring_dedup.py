"""Substring deduplication: words under a window that also starts in an earlier document go.

1. Documents are packed into blocks, written once to the shared folder.
2. Each block hashes all its windows (Rabin-Karp). Per distinct hash it sends the hash and its smallest document, dealt to
   buckets by the top bits of the hash; a passage that a third of all documents hold is sent once a block, not once a
   document.
3. Each bucket counts: for each hash it finds the smallest document of all blocks, and answers every block with one bit
   per hash it sent: does it start in an earlier document than any of this block?
4. Each block, joined with its answers, marks its repeated windows, merges them into maximal intervals and cuts these.

A bucket holds a bounded share of the hash space; their number grows with the number of windows. Hashes have 64 bits, so
among n windows about n * n / 2 ** 65 unequal pairs share one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lilt.llm import blocks as B
from lilt.llm.common import WordHashes, bounded_batches, cut, give_back

#: Distinct hashes a bucket is planned for.
BUCKET_HASHES = 4_000_000
#: Bytes of rows after which a task returns them; hashes of a bucket compared at a time.
RETURN_BYTES, SLICE = 1 << 20, 1 << 17
RESULT = "doc_id long, n_words long, n_removed long, intervals array<struct<start: long, stop: long>>, text string"


class BlockWindows:
    """The windows of a block: hashes, ranks of their documents, and the distinct hashes with their smallest document.

    Words of one text at a time are held as objects; the arrays of all windows are in 32 bits but for the hashes.
    """

    def __init__(self, packed: bytes, window: int, memo: WordHashes) -> None:
        self.ids, self.given, self.texts = B.open_block(packed)
        memo.trim()
        counts, rolled = [], [np.zeros(0, np.uint64)]
        for text, given in zip(self.texts, self.given, strict=True):
            words = text.split() if text and given else ()
            counts.append(max(0, len(words) - window + 1))
            if counts[-1]:
                rolled.append(B.rolling(B.word_hashes(words, memo), window))
        self.counts = np.array(counts, np.int64)
        h = np.concatenate(rolled)
        del rolled
        # ids ascend, so a stable sort by hash leaves each run's smallest document first
        order = np.argsort(h, kind="stable")
        ranked = h[order]
        del h
        self.order = order.astype(np.int32)
        del order
        starts = np.ones(len(ranked), bool)
        np.not_equal(ranked[1:], ranked[:-1], out=starts[1:])
        self.hashes = ranked[starts]
        self.run = np.cumsum(starts, dtype=np.int32)
        self.run -= 1
        different, rank = np.unique(self.ids, return_inverse=True)
        self.rank = np.repeat(rank.astype(np.int32), self.counts)[self.order]
        self.lowest = self.rank[starts]
        self.different = different

    def smallest(self, at: int, end: int) -> np.ndarray:
        """The smallest documents of distinct hashes from one place to another."""
        return self.different[self.lowest[at:end]]

    def repeated(self, earlier: np.ndarray) -> np.ndarray:
        """Which windows, in document order, also start in an earlier document. earlier: by distinct hash, if outside this block."""
        marks = np.zeros(len(self.order), bool)
        marks[self.order] = earlier[self.run] | (self.rank > self.lowest[self.run])
        return marks


def _bounds(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket's part of ascending hashes ends."""
    tops = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.append(np.searchsorted(hashes, tops), len(hashes))


def _send(window: int, bits: int):
    def block_rows(block: int, packed: bytes, memo: WordHashes) -> Iterator[pa.RecordBatch]:
        w = BlockWindows(packed, window, memo)
        low = int(w.different[w.lowest.min()]) if len(w.lowest) else 0
        at, rows, size = 0, [], 0
        for bucket, end in enumerate(_bounds(w.hashes, bits).tolist()):
            if end > at:
                row = (bucket, block, low, B.pack_sorted(w.hashes[at:end]), B.pack_planes((w.smallest(at, end) - low).astype(np.uint64)))
                rows.append(dict(zip(_SENT.names, row, strict=True)))
                size += len(row[3]) + len(row[4])
            at = end
            if len(rows) == 64 or size > RETURN_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema=_SENT)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("docs"), strict=True):
                yield from block_rows(block, packed.as_py(), memo)  # one block's arrays are gone before the next one's are made
                give_back()
        memo.clear()
        give_back()

    return run


_SENT = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("low", pa.int64()), ("hashes", pa.binary()), ("docs", pa.binary())])
_ANSWER = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("earlier", pa.binary())])


def _count(table: pa.Table) -> pa.Table:
    """For one bucket: which hashes of each block start in a smaller document of another block."""
    blocks, lows = table.column("block").to_pylist(), table.column("low").to_pylist()
    every = [B.unpack_sorted(packed.as_buffer()) for packed in table.column("hashes")]
    lengths = [len(h) for h in every]
    every = np.concatenate(every)
    order = np.argsort(every, kind="stable").astype(np.int32 if len(every) < 1 << 31 else np.int64)
    ranked = every[order]
    del every
    first = np.ones(len(ranked), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=first[1:])
    del ranked
    run, first = np.cumsum(first, dtype=order.dtype), np.flatnonzero(first)
    run -= 1
    smallest = np.empty(len(order), np.int64)
    at = 0
    for low, n, packed in zip(lows, lengths, table.column("docs"), strict=True):
        np.add(B.unpack_planes(packed.as_buffer()).astype(np.int64), low, out=smallest[at : at + n])
        at += n
    smallest = smallest[order]
    lowest = np.minimum.reduceat(smallest, first)
    del first
    earlier = np.zeros(len(order), bool)
    for a in range(0, len(order), SLICE):
        earlier[order[a : a + SLICE]] = smallest[a : a + SLICE] > lowest[run[a : a + SLICE]]
    del order, run, smallest, lowest
    out, at = [], 0
    for block, bucket, n in zip(blocks, table.column("bucket").to_pylist(), lengths, strict=True):
        bits = earlier[at : at + n]
        at += n
        if bits.any():
            out.append({"block": block, "bucket": bucket, "earlier": np.packbits(bits).tobytes()})
    give_back()
    return pa.Table.from_pylist(out, schema=_ANSWER)


def _apply(window: int, bits: int):
    def block_rows(packed: bytes, answers: list[dict], memo: WordHashes) -> Iterator[pa.RecordBatch]:
        w = BlockWindows(packed, window, memo)
        earlier, starts = np.zeros(len(w.hashes), bool), np.concatenate([[0], _bounds(w.hashes, bits)])
        for a in answers:
            at, end = starts[a["bucket"]], starts[a["bucket"] + 1]
            earlier[at:end] = np.unpackbits(np.frombuffer(a["earlier"], np.uint8), count=end - at).astype(bool)
        marks, ids, given, texts, counts = w.repeated(earlier), w.ids, w.given, w.texts, w.counts.tolist()
        del w, earlier
        at, out, size = 0, [], 0
        for i, n in enumerate(counts):
            words = (texts[i] or b"").split()
            spans = intervals(marks[at : at + n], window)
            at += n
            kept, last = [], 0
            for start, stop in spans:
                kept += words[last:start]
                last = stop
            kept += words[last:]
            text = None if texts[i] is None else b" ".join(kept).decode(errors="replace")
            gone = sum(stop - start for start, stop in spans)
            out.append({"doc_id": int(ids[i]) if given[i] else None, "n_words": len(words), "n_removed": gone, "intervals": [{"start": a, "stop": b} for a, b in spans], "text": text})
            size += len(text or "")
            if len(out) == 1000 or size > RETURN_BYTES:
                yield pa.RecordBatch.from_pylist(out, schema=_RESULT)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            for packed, answers in zip(batch.column("docs"), batch.column("answers"), strict=True):
                yield from block_rows(packed.as_py(), answers.as_py() or [], memo)
                give_back()
        memo.clear()
        give_back()

    return run


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("intervals", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("text", pa.string())])


def intervals(marks: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal intervals [start, stop) of words under the marked windows."""
    starts = np.flatnonzero(marks)
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > window)
    firsts, lasts = starts[np.concatenate([[0], breaks + 1])], starts[np.concatenate([breaks, [len(starts) - 1]])]
    return list(zip(firsts.tolist(), (lasts + window).tolist(), strict=True))


def dedup_substrings(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, intervals, text): each document without its repeated passages.

    A window is ``window`` consecutive words of one document; a word goes if a window over it has the words of a window
    that starts in a document with a smaller id, both judged on the input. text is the kept words joined by one space;
    intervals are the removed word ranges. Every input row returns once. A null text stays null with no words; texts
    shorter than a window stay whole; rows with a null id keep all and make nobody else lose any; rows that share an id
    don't make each other lose any. Other columns of docs don't matter and don't return. An empty table gives no rows.
    """
    spark = docs.sparkSession
    blocks = cut(B.make_blocks(docs, id_col, text_col))
    words = (blocks.agg(F.sum("n_bytes")).first()[0] or 0) / 6
    bits = max(0, int(np.ceil(np.log2(max(1.0, words / BUCKET_HASHES)))))
    bounded_batches(spark, mb=4)  # one or two blocks
    sent = blocks.select("block", "docs").mapInArrow(_send(window, bits), "bucket long, block long, low long, hashes binary, docs binary")
    answers = sent.groupBy("bucket").applyInArrow(_count, "block long, bucket long, earlier binary")
    per_block = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "earlier")).alias("answers"))
    joined = blocks.join(per_block, "block", "left").select("docs", "answers")
    return joined.mapInArrow(_apply(window, bits), RESULT)
