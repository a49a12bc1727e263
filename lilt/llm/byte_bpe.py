"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Merges wait in buckets, one per merge rank; a bucket holds positions of a linked list of symbols, and a two-level bitmap
(256 words of 256 bits) says which buckets hold any. Find-first-set picks the lowest rank, and entries whose pair has changed
since are skipped.

All new pre-tokens of a batch stand in one linked list, set apart by barriers, and share one queue: a bucket is taken as a
whole, from left to right without overlap, in array operations (``sweep``). Ranks rise, and the more frequent merges come
first; once buckets hold few positions, what is left of each pre-token goes through a queue of its own, entry by entry
(``merge``). Either way a merge costs a few constant-time steps whatever the length, so a pre-token of a million bytes takes
near-linear time.
"""

from __future__ import annotations

import base64
import struct
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lilt.llm.common import Generations, append_columns

#: Entries of a task's younger memos of pre-tokens and of space-led chunks, the longest one remembered, characters of texts at a time.
MEMO_ENTRIES, MEMO_CHARS, GROUP_CHARS = 100_000, 64, 2 << 20
#: Fewest bytes for a sweep, bytes of one sweep, mean positions of a bucket at which it ends.
SWEEP_FROM, SWEEP_BYTES, SPARSE = 256, 1 << 20, 4
#: Symbols whose pairs are looked up, or ids that are decoded, at a time.
SLICE = 1 << 17
#: The symbol of a barrier; no rank is as high.
BARRIER = 65535


class RankQueue:
    """Min-queue over (rank, position) for ranks below 65,536.

    ``top`` has bit h set if leaf h isn't 0; leaf h has bit l set if bucket 256 * h + l holds positions. A bucket is a heap of
    positions or, in a sweep, a list of arrays of them. Entries may go stale; whoever pops skips them. ByteBPE works on the
    fields itself, since a method call for each entry would take most of its time.
    """

    def __init__(self) -> None:
        self.top = 0
        self.leaves = [0] * 256
        self.buckets: list[list] = [[] for _ in range(65536)]

    def put(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Deals positions, in ascending order, to the buckets of their ranks."""
        if len(ranks) > 1:
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            parts = zip(ranks[np.concatenate([[0], cuts])].tolist(), [0, *cuts.tolist()], [*cuts.tolist(), len(ranks)], strict=True)
        else:
            parts = [(int(r), 0, 1) for r in ranks]
        buckets, leaves = self.buckets, self.leaves
        for rank, a, b in parts:
            if not (bucket := buckets[rank]):
                leaves[rank >> 8] |= _BIT[rank & 255]
                self.top |= _BIT[rank >> 8]
            bucket.append(positions[a:b])

    def take(self) -> tuple[int, list[np.ndarray]]:
        """The lowest rank and its whole bucket."""
        high = _NUMBER[self.top & -self.top]
        leaf = self.leaves[high]
        rank = high << 8 | _NUMBER[leaf & -leaf]
        self.leaves[high] = leaf = leaf & (leaf - 1)
        if not leaf:
            self.top &= self.top - 1
        bucket, self.buckets[rank] = self.buckets[rank], []
        return rank, bucket


#: 1 << n, and the bit number of a power of two below 2 ** 256.
_BIT = [1 << n for n in range(256)]
_NUMBER = {bit: n for n, bit in enumerate(_BIT)}


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class ByteBPE:
    """Encoder and decoder for a rank file: lines of base64 token and rank, a token's rank being its id."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        if len(self.tokens) > BARRIER:
            raise ValueError("ranks must be below 65,535")
        self.of_byte = [self.ranks[bytes([b])] for b in range(256)]
        self.symbols = np.array(self.of_byte, np.int32)
        self.keys, self.made = self._pairs()
        self.find = regex.compile(pattern).findall
        self.pairs = dict(zip(self.keys.tolist(), self.made.tolist(), strict=True))
        self.queue = RankQueue()

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Ascending left << 16 | right of all pairs of tokens that make a token, and the ranks of what they make."""
        ranks, found = self.ranks, []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found.append((left << 16 | right, rank))
        keys, made = np.array(found, np.int64).reshape(-1, 2).T
        order = np.argsort(keys)
        return keys[order], made[order].astype(np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the tokens that pairs of symbols make; -1 if none."""
        keys = left.astype(np.int64) << 16 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.made[at], -1)

    def merge(self, ids: list[int]) -> list[int]:
        """Ids of one pre-token, from the symbols it consists of so far."""
        n, pairs = len(ids), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue, top = self.queue, 0
        leaves, buckets = queue.leaves, queue.buckets
        wanted = [-1] * n
        fresh = range(n - 1)
        while True:
            for i in fresh:
                wanted[i] = rank = pairs.get(ids[i] << 16 | ids[after[i]], -1)
                if rank >= 0:
                    bucket = buckets[rank]
                    if bucket:
                        heappush(bucket, i)
                    else:
                        bucket.append(i)
                        leaves[rank >> 8] |= _BIT[rank & 255]
                        top |= _BIT[rank >> 8]
            while top:
                high = _NUMBER[top & -top]
                leaf = leaves[high]
                rank = high << 8 | _NUMBER[leaf & -leaf]
                bucket = buckets[rank]
                if len(bucket) > 1:
                    i = heappop(bucket)
                else:
                    i = bucket.pop()
                    leaves[high] = leaf = leaf & (leaf - 1)
                    if not leaf:
                        top &= top - 1
                if wanted[i] == rank:
                    break
            else:
                break
            ids[i] = rank
            gone = after[i]
            wanted[gone] = wanted[i] = -1
            after[i] = right = after[gone]
            left = before[i]
            if right < n:
                before[right] = i
                fresh = (left, i) if left >= 0 else (i,)
            else:
                fresh = (left,) if left >= 0 else ()
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def sweep(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens, none empty."""
        return [np.frombuffer(ids, "<u4").tolist() for ids in self.sweep_packed(pieces)]

    def sweep_packed(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of pre-tokens, none empty.

        Taking a whole bucket is the same as taking its positions one by one as long as no merge makes a pair of a lower rank;
        pre-tokens where that happens are done again one by one. The same goes, from the symbols reached so far, for pre-tokens
        that still have merges once buckets are sparse.
        """
        text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        n, owner = len(text), np.repeat(np.arange(len(pieces), dtype=np.int32), lengths + 1)
        ids = self.symbols[text]
        ids[ends] = BARRIER
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        wanted = np.full(n, -1, np.int32)
        for a in range(0, n - 1, SLICE):
            wanted[a : a + SLICE][: n - 1 - a] = self.rank_of(ids[a : a + SLICE][: n - 1 - a], ids[a + 1 : a + SLICE + 1])
        queue, again, unfinished = self.queue, set(), set()
        dead = np.zeros(n, bool)
        dead[ends] = True
        first = np.flatnonzero(wanted >= 0).astype(np.int32)
        if len(first):
            queue.put(wanted[first], first)
        most = 50 * SPARSE
        mean = float(most)
        while queue.top and mean >= SPARSE:
            rank, bucket = queue.take()
            at = np.sort(np.concatenate(bucket)) if len(bucket) > 1 else bucket[0]
            at = at[wanted[at] == rank]
            mean += 0.02 * (min(len(at), most) - mean)
            if not len(at):
                continue
            touching = after[at[:-1]] == at[1:]
            if touching.any():  # of a run of overlapping pairs, the first, the third and so on
                run = np.flatnonzero(np.concatenate([[True], ~touching]))
                place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
                at = at[place % 2 == 0]
            gone = after[at]
            right = after[gone]
            ids[at] = rank
            after[at], before[right], wanted[gone], dead[gone] = right, at, -1, True
            left = before[at]
            left = left[left >= 0]
            touched = np.concatenate([at, left[ids[left] != rank]])
            made = self.rank_of(ids[touched], ids[after[touched]])
            wanted[touched] = made
            some = made >= 0
            if not some.any():
                continue
            touched, made = touched[some], made[some]
            if (made < rank).any():
                again.update(owner[touched[made < rank]].tolist())
            queue.put(made, touched)
        while queue.top:
            rank, bucket = queue.take()
            at = np.concatenate(bucket)
            unfinished.update(owner[at[wanted[at] == rank]].tolist())
        alive = np.flatnonzero(~dead)
        symbols, stops = ids[alive].astype("<u4").tobytes(), np.cumsum(np.bincount(owner[alive], minlength=len(pieces))).tolist()
        out, at = [], 0
        for i, stop in enumerate(stops):
            if i in again:
                out.append(packed(self.merge([self.of_byte[b] for b in pieces[i]])))
            elif i in unfinished:
                out.append(packed(self.merge(np.frombuffer(symbols, "<u4", stop - at, 4 * at).tolist())))
            else:
                out.append(symbols[4 * at : 4 * stop])
            at = stop
        return out

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of different pre-tokens."""
        raw = [p.encode() for p in pieces]
        found: list[bytes | None] = [None if (whole := self.ranks.get(b)) is None else packed([whole]) for b in raw]
        rest = [i for i, ids in enumerate(found) if ids is None]
        at = 0
        while at < len(rest):
            size, stop = 0, at
            while stop < len(rest) and (stop == at or size + len(raw[rest[stop]]) <= SWEEP_BYTES):
                size += len(raw[rest[stop]])
                stop += 1
            part = rest[at:stop]
            own = [raw[i] for i in part]
            swept = self.sweep_packed(own) if size >= SWEEP_FROM else [packed(self.merge([self.of_byte[b] for b in x])) for x in own]
            for i, ids in zip(part, swept, strict=True):
                found[i] = ids
            at = stop
        return found

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for."""
        get, whole = self.tokens.__getitem__, np.frombuffer(ids, "<u4")
        return b"".join([b"".join(map(get, whole[a : a + SLICE].tolist())) for a in range(0, len(whole), SLICE)])


class TextCodec:
    """Encodes texts with a task's memos of pre-tokens and space-led chunks."""

    def __init__(self, bpe: ByteBPE) -> None:
        self.bpe = bpe
        self.pre_tokens, self.chunks = Generations(MEMO_ENTRIES), Generations(MEMO_ENTRIES)

    def _know(self, heads: list[list[str]], tails: list[list[str]], texts: list[str | None]) -> None:
        """Makes sure that the younger memos have the pre-tokens of heads and the chunks of tails.

        Where every space stands between two characters that are not white space, the pattern always cuts before the space, so
        each space-led chunk can be looked up as a whole. The text of a chunk for which that doesn't hold is split anew.
        """
        find, pre, chunks = self.bpe.find, self.pre_tokens, self.chunks
        new = chunks.lacking(set().union(*tails))
        odd = {c for c in new if not c or c[0].isspace() or c[-1].isspace()}
        if odd:
            for i, rest in enumerate(tails):
                if not odd.isdisjoint(rest):
                    heads[i], tails[i] = find(texts[i]), []
            new = [c for c in new if c not in odd]
        plain = [c for c in new if c.isascii() and c.isalpha()]
        other = [c for c in new if not (c.isascii() and c.isalpha())]
        split = [find(" " + c) for c in other]
        unknown = pre.lacking(set().union(*heads, *split))
        ids = self.bpe.encode_pieces([" " + c for c in plain] + unknown)
        chunks.young.update(zip(plain, ids, strict=False))
        pre.young.update(zip(unknown, ids[len(plain) :], strict=True))
        get = pre.young.__getitem__
        chunks.young.update(zip(other, [b"".join(map(get, own)) for own in split], strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, at = [], 0
        while at < len(texts):
            size, stop = 0, at
            while stop < len(texts) and (stop == at or size + len(texts[stop] or "") <= GROUP_CHARS):
                size += len(texts[stop] or "")
                stop += 1
            part = texts[at:stop]
            heads, tails = [], []
            for text in part:
                first, *rest = (text or "").split(" ")
                if rest and (not first or first[-1].isspace()):
                    first, rest = text, []
                heads.append(self.bpe.find(first))
                tails.append(rest)
            self._know(heads, tails, part)
            pre, chunk = self.pre_tokens.young.__getitem__, self.chunks.young.__getitem__
            out += [b"".join([*map(pre, first), *map(chunk, rest)]) for first, rest in zip(heads, tails, strict=True)]
            self.pre_tokens.trim(MEMO_CHARS)
            self.chunks.trim(MEMO_CHARS)
            at = stop
        return out


_CODECS: dict[tuple[str, str], ByteBPE] = {}


def codec(ranks_path: str, pattern: str) -> ByteBPE:
    """The worker's codec for a rank file, built once."""
    if (ranks_path, pattern) not in _CODECS:
        _CODECS[ranks_path, pattern] = ByteBPE(ranks_path, pattern)
    return _CODECS[ranks_path, pattern]


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", only: list[str] | None = None) -> DataFrame:
    """docs with ``token_ids`` (binary, little-endian unsigned 32-bit ids) and ``n_tokens`` (long).

    A null text counts as empty: no ids, n_tokens 0. Special tokens are ordinary text. Rows are independent, so ties and
    repeated rows encode alike; input columns named like the new ones are replaced.
    """

    def make():
        bpe = codec(ranks_path, pattern)
        texts = TextCodec(bpe)

        def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
            ids = texts.encode(batch.column(text_col).to_pylist())
            return [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]

        return kernel

    fields = [T.StructField("token_ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    return append_columns(docs, make, fields, only, runs=(text_col, GROUP_CHARS))


def decode(encoded: DataFrame, ranks_path: str, pattern: str, only: list[str] | None = None) -> DataFrame:
    """encoded with ``decoded`` (binary): the bytes that its ``token_ids`` stand for; empty for null."""

    def make():
        bpe = codec(ranks_path, pattern)
        return lambda batch: [pa.array([bpe.decode(x or b"") for x in batch.column("token_ids").to_pylist()], pa.binary())]

    return append_columns(encoded, make, [T.StructField("decoded", T.BinaryType())], only)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", only: list[str] | None = None) -> DataFrame:
    """encode() and decode() in one pass over the rows: ``token_ids``, ``n_tokens`` and ``decoded``.

    A task holds ids and decoded bytes of one group of texts at a time, not those of a whole Arrow batch.
    """

    def make():
        bpe = codec(ranks_path, pattern)
        texts = TextCodec(bpe)

        def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
            ids = texts.encode(batch.column(text_col).to_pylist())
            return [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([bpe.decode(x) for x in ids], pa.binary())]

        return kernel

    fields = [T.StructField("token_ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.BinaryType())]
    return append_columns(docs, make, fields, only, runs=(text_col, GROUP_CHARS))
