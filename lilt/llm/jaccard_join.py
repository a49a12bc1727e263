"""N-gram Jaccard join: a size-aware heavy-light join over sets of word shingles.

Documents with the same set are one set from the start. Then:

* Light sets (at most ``boundary`` shingles) enumerate, for each size a partner may have, their subsets of the size that
  an overlap must reach; two light sets share such a subset if and only if they are linked.
* Heavy sets go into inverted lists and each list is scanned for links. Lists of single shingles would hold a third
  of all documents for a common passage, so a list stands for a whole part of a set: shingles are dealt by hash to one part
  more than two linked sets can differ in, plus spare ones for parts that stay empty, so linked sets agree on a part
  that isn't empty.
* The boundary is the size up to which enumerating costs less than the lists and verification of a set; light sets
  that may have heavy partners enter the lists as well.

Sets that share lists or subsets meet, grouped by the smallest set of a list. Most share no more than a passage, so they
meet by their sketches first, a byte for about three shingles: counts of hashes in bins, whose differences never add up to
more than the shingles by which two sets differ. What may be linked after that is verified by all hashes, in groups that
possible links connect. A group is cut into tiles of bounded size; a pair of tiles compares its sketches, or multiplies its
0/1 matrices, and returns only the links of a spanning forest. So neither a list nor a group of near copies is ever expanded
into pairs of rows, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb, exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lilt.llm import blocks as B
from lilt.llm.common import WordHashes, bounded_batches, cut, free_shuffles, give_back, small, utf8
from lilt.llm.components import components

#: Share of sets that may have more empty parts than there are spare ones; such a set lists its empty parts as well.
CROWDED = 1e-7
#: Low bits of a key: it is for two sizes of light sets; its set is the larger one; the sizes are equal.
LIGHT, LARGER, EQUAL = 1, 2, 4
#: Shingles for a bin of a sketch, at most; bins at least; shingles of a tile of sketches for one of a tile of hashes.
BIN_SHINGLES, LEAST_BINS, SKETCH_TILES = 4, 16, 8
#: Sets and shingles in a tile, keys in a bucket, keys that a task packs together, columns of a matrix and rows of a comparison at a time.
TILE, TILE_SHINGLES, BUCKET_KEYS, PACK_KEYS, COLUMNS, ROWS = 2048, 600_000, 1_000_000, 500_000, 1024, 256


class Sizes:
    """What the threshold (percent) says about set sizes."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.starts = [1]
        self.boundary = 0
        self.dealt: dict[int, tuple[int, int]] = {}
        size = 1
        while self.light_cost(size) <= self.heavy_cost(size):
            self.boundary = size
            size += 1

    def overlap(self, a: int, b: int) -> int:
        """Least intersection of linked sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def partners(self, size: int) -> range:
        """Sizes that a linked set may have."""
        return range(-(-self.percent * size // 100), 100 * size // self.percent + 1)

    def level(self, size: int) -> int:
        """Class of a size: linked sets are in the same or in neighbouring classes."""
        while self.starts[-1] <= size:
            self.starts.append(100 * self.starts[-1] // self.percent + 1)
        return int(np.searchsorted(self.starts, size, side="right")) - 1

    def parts(self, level: int) -> tuple[int, int]:
        """Parts of the sets listed at a level, which serves pairs whose smaller set is of that class, and the spare ones.

        Linked sets of sizes a and b differ in at most (a + b) * (100 - percent) / (100 + percent) shingles. Spare parts are
        added until a Poisson number of empty parts exceeds them for a share CROWDED of the smallest sets, at most as many as
        there are others.
        """
        if level not in self.dealt:
            while len(self.starts) <= level + 1:
                self.starts.append(100 * self.starts[-1] // self.percent + 1)
            small = self.starts[level + 1] - 1
            large = 100 * small // self.percent
            needed, spare = (small + large) * (100 - self.percent) // (100 + self.percent) + 1, 1
            while spare < needed and poisson_tail((needed + spare) * exp(-self.starts[level] / (needed + spare)), spare) > CROWDED:
                spare += max(1, spare // 8)
            self.dealt[level] = needed + spare, spare
        return self.dealt[level]

    def levels(self, size: int) -> list[int]:
        """Levels at which a set is listed: its own, for larger partners, and the one below, for smaller ones."""
        own = self.level(size)
        return [own, own - 1] if own else [own]

    def light_cost(self, size: int) -> int:
        return sum(comb(size, self.overlap(size, other)) for other in self.partners(size) if self.overlap(size, other) < max(size, other))

    def heavy_cost(self, size: int) -> int:
        return sum(self.parts(level)[0] for level in self.levels(size)) + size

    def keys(self, size: int) -> int:
        """Keys that a set of this size emits, at most."""
        light = sum(comb(size, self.overlap(size, other)) for other in self.partners(size) if self.has_subsets(size, other)) if self.is_light(size) else 0
        return light + (sum(self.parts(level)[0] for level in self.levels(size)) if self.is_listed(size) else 0)

    def has_subsets(self, size: int, other: int) -> bool:
        """Whether a light set of a size lists subsets for partners of another."""
        return 1 <= other <= self.boundary and self.overlap(size, other) <= size and self.overlap(size, other) < max(size, other)

    def is_light(self, size: int) -> bool:
        return size <= self.boundary

    def is_listed(self, size: int) -> bool:
        return 100 * size // self.percent > self.boundary


def poisson_tail(mean: float, most: int) -> float:
    """Probability that a Poisson number exceeds most, at most 1."""
    if most <= mean:
        return 1.0
    return min(1.0, exp((most + 1) * log(mean) - mean - lgamma(most + 2)) * (most + 2) / (most + 2 - mean)) if mean > 0 else 0.0


def shingles(text: bytes | None, n: int, memo: WordHashes) -> np.ndarray:
    """Ascending distinct hashes of a text's n-word shingles; of the whole sequence if it has fewer words."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(B.rolling(B.word_hashes(words, memo), min(n, len(words))))


def set_id(hashes: np.ndarray) -> int:
    """64-bit identity of a set, as a signed integer."""
    a = B.spread(hashes).sum(dtype=np.uint64)
    b = B.spread(hashes ^ np.uint64(B.SPREAD[0])).sum(dtype=np.uint64)
    return int(B.spread(np.array([a ^ (b << np.uint64(1) | b >> np.uint64(63)) ^ np.uint64(len(hashes))], np.uint64)).view(np.int64)[0])


def sketch(hashes: np.ndarray) -> bytes:
    """Counts of a set's hashes in a power of two of bins, a byte each."""
    bins = LEAST_BINS
    while bins * BIN_SHINGLES < len(hashes):
        bins *= 2
    place = (B.spread(hashes + np.uint64(B.MULTIPLIER)) >> np.uint64(16)).astype(np.int64)
    while (counts := np.bincount(place & (bins - 1), minlength=bins)).max() > 255:
        bins *= 2
    return counts.astype(np.uint8).tobytes()


def light_keys(hashes: np.ndarray, sizes: Sizes) -> list[np.ndarray]:
    """Keys of the subsets that a light set shares with any light set linked to it.

    A key is for two sizes. Sets of both sizes that share it are linked; several of the larger size alone are not.
    """
    n, out = len(hashes), []
    mixed = B.spread(hashes)
    total = mixed.sum(dtype=np.uint64)
    for other in sizes.partners(n):
        if not sizes.has_subsets(n, other):
            continue
        take = sizes.overlap(n, other)
        gone = np.array([mixed[list(c)].sum(dtype=np.uint64) for c in combinations(range(n), n - take)], np.uint64)
        label = B.spread(np.array([min(n, other) << 32 | max(n, other)], np.uint64))
        role = LIGHT | (EQUAL if other == n else LARGER if other < n else 0)
        out.append(B.spread(total - gone + label) & ~np.uint64(7) | np.uint64(role))
    return out


def list_keys(sets: list[np.ndarray], level: int, parts: int, spare: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts of some sets at a level, and which set each is of."""
    lengths = [len(s) for s in sets]
    every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
    place = owner * parts + (B.spread(every ^ np.uint64(B.SPREAD[1])) >> np.uint64(11)).astype(np.int64) % parts
    sums, counts = np.zeros(len(sets) * parts, np.uint64), np.bincount(place, minlength=len(sets) * parts)
    np.add.at(sums, place, B.spread(every))
    label = B.spread((np.uint64(level) << np.uint64(32)) + np.arange(parts, dtype=np.uint64))
    keys = B.spread(sums + np.tile(label, len(sets))) & ~np.uint64(7)
    many_empty = (counts.reshape(-1, parts) == 0).sum(axis=1) > spare
    used = (counts > 0) | np.repeat(many_empty, parts)
    return keys[used], np.repeat(np.arange(len(sets)), parts)[used]


def _describe(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            sets = [shingles(t, n, memo) for t in utf8(batch.column(1))]
            memo.trim()
            ids, sketches = [set_id(s) if len(s) else None for s in sets], [sketch(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.int64()), pa.array(sketches, pa.binary())], names=["doc_id", "n_shingles", "set_id", "sketch"])

    return run


#: A bucket's keys of one pack, ascending; the different sets that have them, ascending; which of these each key is of.
_KEYS = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("sets", pa.binary()), ("owners", pa.binary())])


def _emit(n: int, sizes: Sizes, bits: int):
    def keys_of(found: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Keys of some sets and the set of each."""
        keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        listed: dict[int, list[int]] = {}
        for i, s in found.items():
            if sizes.is_light(len(s)):
                for k in light_keys(s, sizes):
                    keys.append(k)
                    owners.append(np.full(len(k), i, np.int64))
            if sizes.is_listed(len(s)):
                for level in sizes.levels(len(s)):
                    listed.setdefault(level, []).append(i)
        for level, ids in listed.items():
            for at in range(0, len(ids), 256):
                part = ids[at : at + 256]
                k, owner = list_keys([found[i] for i in part], level, *sizes.parts(level))
                keys.append(k)
                owners.append(np.array(part, np.int64)[owner])
        return np.concatenate(keys), np.concatenate(owners)

    def packed(k: np.ndarray, o: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A row for each bucket that has some of these keys."""
        order = np.argsort(k, kind="stable")
        k, o = k[order], o[order]
        ends = np.append(np.searchsorted(k, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else [], len(k)).astype(int).tolist()
        at, rows = 0, []
        for bucket, end in enumerate(ends):
            if end > at:
                sets, owners = np.unique(o[at:end].view(np.uint64), return_inverse=True)
                rows.append({"bucket": bucket, "keys": B.pack_sorted(k[at:end]), "sets": B.pack_sorted(sets), "owners": B.pack_planes(owners)})
            at = end
        for start in range(0, len(rows), 1000):
            yield pa.RecordBatch.from_pylist(rows[start : start + 1000], schema=_KEYS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, count = WordHashes(), [], 0
        for batch in batches:
            texts = utf8(batch.column(1))
            for start in range(0, len(texts), 1024):
                found: dict[int, np.ndarray] = {}
                for t in texts[start : start + 1024]:
                    s = shingles(t, n, memo)
                    if len(s):
                        found[set_id(s)] = s  # copies side by side count once
                memo.trim()
                held.append(keys_of(found))
                count += len(held[-1][0])
                if count >= PACK_KEYS:
                    yield from packed(*map(np.concatenate, zip(*held, strict=True)))
                    held, count = [], 0
        if count:
            yield from packed(*map(np.concatenate, zip(*held, strict=True)))
        del memo, held
        give_back()

    return run


#: Pairs of a list's smallest set and a set of the list, dealt to chunks by a hash of the pair.
_PAIRS = pa.schema([("chunk", pa.int64()), ("leaders", pa.binary()), ("members", pa.binary())])
_MEMBERS = pa.schema([("leader", pa.int64()), ("member", pa.int64())])


def _scan(bits: int):
    def run(table: pa.Table) -> pa.Table:
        """For one bucket: the sets of each list of several, with the list's smallest set."""
        pairs = _lists(table)
        mixed = B.spread(pairs[:, 0].view(np.uint64) ^ B.spread(pairs[:, 1].view(np.uint64)))
        chunk = mixed >> np.uint64(64 - bits) if bits else np.zeros(len(pairs), np.uint64)
        order = np.argsort(chunk, kind="stable")
        chunk, pairs = chunk[order], pairs[order]
        edges = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), len(chunk)] if len(chunk) else []
        rows = []
        for a, b in zip(edges, edges[1:], strict=False):
            rows.append({"chunk": int(chunk[a]), "leaders": B.pack_planes(pairs[a:b, 0].view(np.uint64)), "members": B.pack_planes(pairs[a:b, 1].view(np.uint64))})
        return pa.Table.from_pylist(rows, schema=_PAIRS)

    return run


def _unite(table: pa.Table) -> pa.Table:
    """The different pairs of one chunk, which has all copies of each of its pairs."""
    pairs = np.concatenate([np.stack([B.unpack_planes(x.as_py()), B.unpack_planes(y.as_py())], axis=1).view(np.int64) for x, y in zip(table.column("leaders"), table.column("members"), strict=True)])
    pairs = np.unique(pairs, axis=0)
    return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_MEMBERS)


def _lists(table: pa.Table) -> np.ndarray:
    """The different pairs (smallest set of a list, set of the list) of a bucket's lists of several sets."""
    keys = np.concatenate([B.unpack_sorted(x.as_py()) for x in table.column("keys")])
    sets = np.concatenate([B.unpack_sorted(x.as_py()).view(np.int64)[B.unpack_planes(y.as_py()).view(np.int64)] for x, y in zip(table.column("sets"), table.column("owners"), strict=True)])
    larger, keys = (keys & np.uint64(LARGER)) > 0, keys & ~np.uint64(LARGER)
    order = np.lexsort((sets, keys))
    keys, sets, larger = keys[order], sets[order], larger[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])])
    keys, sets, larger = keys[new], sets[new], larger[new]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    length, larger = np.diff(np.append(first, len(keys))), np.add.reduceat(larger.astype(np.int64), first)
    one_sided = ((keys[first] & np.uint64(LIGHT | EQUAL)) == LIGHT) & ((larger == 0) | (larger == length))
    leader, shared = np.repeat(sets[first], length), np.repeat((length > 1) & ~one_sided, length)
    return np.unique(np.stack([leader[shared], sets[shared]], axis=1), axis=0)


def _load(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            sets = [shingles(t, n, memo) for t in utf8(batch.column(1))]
            memo.trim()
            ok = [len(s) > 0 and set_id(s) == w for w, s in zip(batch.column(0).to_pylist(), sets, strict=True)]
            found = [s for s, good in zip(sets, ok, strict=True) if good]
            kept = batch.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([kept.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary()), kept.column(2)], names=["member", "n", "packed", "to"])
        del memo
        give_back()

    return run


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _meet(hits: Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray], np.ndarray]):
    """For a pair of tiles: a spanning forest of hits(packed sets, their sizes, rows, columns)."""

    def links(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        ids, tile = table.column("member").to_pylist(), np.array(table.column("tile").to_pylist())
        rows = np.flatnonzero(tile == i)
        cols = rows if i == j else np.flatnonzero(tile == j)
        edges = forest(hits(table.column("packed").to_pylist(), np.array(table.column("n").to_pylist(), np.int64), rows, cols), rows, cols)
        return pa.Table.from_arrays([pa.array([ids[a] for a, _ in edges], pa.int64()), pa.array([ids[b] for _, b in edges], pa.int64())], schema=_LINKS)

    return links


def linked(percent: int):
    def hits(packed: list[bytes], n: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """Whether the sets at rows are linked with those at cols, by their hashes."""
        both = overlaps([np.frombuffer(x, np.uint64) for x in packed], rows, cols)
        hit = np.empty(both.shape, bool)
        for at in range(0, len(rows), ROWS):
            part = both[at : at + ROWS].astype(np.int64)
            hit[at : at + ROWS] = 100 * part >= percent * (n[rows[at : at + ROWS]][:, None] + n[cols][None, :] - part)
        return hit

    return hits


def maybe_linked(percent: int):
    def hits(packed: list[bytes], n: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """Whether the sets at rows may be linked with those at cols, by their sketches: true wherever linked() is.

        Sets of sizes a and b are linked if they differ in at most a + b - 2 * least overlap shingles, and counts in bins
        differ by no more than that. The finer of two sketches is folded to the bins of the other.
        """
        hit = np.zeros((len(rows), len(cols)), bool)
        bins = np.array([len(x) for x in packed], np.int64)
        for of_rows in np.unique(bins[rows]).tolist():
            xs = np.flatnonzero(bins[rows] == of_rows)
            for of_cols in np.unique(bins[cols]).tolist():
                ys = np.flatnonzero(bins[cols] == of_cols)
                ys = ys[np.argsort(n[cols[ys]], kind="stable")]
                a, b = n[rows[xs]], n[cols[ys]]
                start, end = np.searchsorted(100 * b, percent * a), np.searchsorted(percent * b, 100 * a, side="right")
                if (start < end).any():
                    width = min(of_rows, of_cols)
                    left, right = folded([packed[r] for r in rows[xs]], width), folded([packed[c] for c in cols[ys]], width)
                    for x, s, e in zip(range(len(xs)), start.tolist(), end.tolist(), strict=True):
                        if s < e:
                            total = a[x] + b[s:e]
                            most = total - 2 * -(-percent * total // (100 + percent))
                            hit[xs[x], ys[s:e]] = np.abs(right[s:e] - left[x]).sum(axis=1, dtype=np.int64) <= most
        return hit

    return hits


def folded(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches of one number of bins, with ``width`` bins."""
    counts = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1, width)
    return counts.sum(axis=1, dtype=np.int32 if counts.shape[1] > 64 else np.int16)


def overlaps(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Intersection sizes of the sets at rows with those at cols, by products of 0/1 matrices over shared hashes."""
    used = np.union1d(rows, cols)
    every, owner = np.concatenate([sets[u] for u in used]), np.repeat(used, [len(sets[u]) for u in used])
    _, column, times = np.unique(every, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    row_of, col_of = np.full(len(sets), -1), np.full(len(sets), -1)
    row_of[rows], col_of[cols] = np.arange(len(rows)), np.arange(len(cols))
    # 32-bit floats count exactly up to 2 ** 24
    total = np.zeros((len(rows), len(cols)), np.float32 if max(map(len, sets)) < 1 << 24 else np.float64)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        o, c = owner[a:b], column[a:b] - start
        width = int(c.max()) + 1
        left, right = np.zeros((len(rows), width), np.float32), np.zeros((len(cols), width), np.float32)
        ok = row_of[o] >= 0
        left[row_of[o[ok]], c[ok]] = 1
        ok = col_of[o] >= 0
        right[col_of[o[ok]], c[ok]] = 1
        total += left @ right.T
    return total


def forest(hit: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph in which rows[x] and cols[y] are linked where hit[x, y]."""
    edges: list[tuple[int, int]] = []
    row_at, col_at = {int(r): x for x, r in enumerate(rows)}, {int(c): y for y, c in enumerate(cols)}
    seen: set[int] = set()
    row_free, col_free = np.ones(len(rows), bool), np.ones(len(cols), bool)
    for start in rows.tolist():
        if start in seen:
            continue
        stack = [start]
        seen.add(start)
        while stack:
            node = stack.pop()
            near: list[int] = []
            if (x := row_at.get(node)) is not None:
                row_free[x] = False
                near += cols[np.flatnonzero(hit[x] & col_free)].tolist()
            if (y := col_at.get(node)) is not None:
                col_free[y] = False
                near += rows[np.flatnonzero(hit[:, y] & row_free)].tolist()
            for other in near:
                if other not in seen:
                    seen.add(other)
                    edges.append((node, other))
                    stack.append(other)
                    if (x := row_at.get(other)) is not None:
                        row_free[x] = False
                    if (y := col_at.get(other)) is not None:
                        col_free[y] = False
    return edges


def gathered(members: DataFrame) -> DataFrame:
    """members (leader, member), every leader among its own, with fewer groups: those of leaders that share a smaller leader are one.

    Near copies share many lists, whose smallest sets differ; a leader gives its group to the smallest leader that it has
    itself, and that one to its own, so a set's shingles travel to fewer groups. Sets that shared a group still do.
    """
    low = members.groupBy("member").agg(F.min("leader").alias("low"))
    top = low.join(low.select(F.col("member").alias("low"), F.col("low").alias("top")), "low").select(F.col("member").alias("leader"), "top")
    return members.join(top, "leader").select(F.col("top").alias("leader"), "member").distinct()


def meetings(members: DataFrame, sets: DataFrame, shingles_each: int) -> DataFrame:
    """(member, n, rep, to): for each member of members (leader, member) the pairs of tiles in which its group needs it."""
    sized = cut(members.join(sets.withColumnRenamed("set_id", "member"), "member"))
    tiles = sized.groupBy("leader").agg(F.expr(f"cast(greatest(ceil(count(1) / {TILE}), ceil(sum(n) / {shingles_each})) as int)").alias("tiles"))
    several = cut(tiles.where("tiles > 1"))
    dealt = sized.join(small(several, several.count()), "leader", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1))).withColumn("tile", F.expr("cast(pmod(xxhash64(member), tiles) as int)"))
    return dealt.withColumn("to", F.expr("transform(sequence(0, tiles - 1), other -> struct(leader, least(tile, other) AS i, greatest(tile, other) AS j, tile))"))


def meet(found: DataFrame, hits: Callable) -> DataFrame:
    """Links (a, b), by hits, of a spanning forest of every pair of tiles; found: (member, n, packed, to)."""
    met = found.select("member", "n", "packed", F.explode("to").alias("to")).select("member", "n", "packed", "to.*")
    return met.groupBy("leader", "i", "j").applyInArrow(_meet(hits), "a long, b long")


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): components of documents whose shingle sets have Jaccard >= percent / 100.

    Words are runs without ASCII white space, A-Z in lower case; a set is the distinct n-word shingles, or the whole
    sequence of a shorter text. component_id is the smallest doc_id that links reach. Every input row returns once. Null,
    empty and blank texts have no shingles and no links. Rows with a null id have a null component and link nothing;
    rows that share an id are separate documents under one id. Other columns don't matter. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = cut(texts.mapInArrow(_describe(n), "doc_id long, n_shingles long, set_id long, sketch binary"))
    named = known.where(F.col("doc_id").isNotNull() & F.col("set_id").isNotNull())
    copies = named.groupBy("set_id", "doc_id").agg(F.count(F.lit(1)).alias("rows"), F.min("n_shingles").alias("n"))
    sets = copies.groupBy("set_id").agg(F.min(F.struct("doc_id", "rows")).alias("rep"), F.min("n").alias("n"))

    sizes = Sizes(percent)
    # at most 256 classes of small sizes and 16 for each doubling beyond
    step = F.when(F.col("n_shingles") < 256, F.col("n_shingles")).otherwise(F.floor(F.log2("n_shingles") * 16) + 256)
    histogram = named.groupBy(step.alias("step")).agg(F.max("n_shingles").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    expected = sum(r["n"] * sizes.keys(r["size"]) for r in histogram)
    bits = max(0, int(np.ceil(np.log2(max(1.0, expected / BUCKET_KEYS)))))
    keys = texts.where(F.col("doc_id").isNotNull()).mapInArrow(_emit(n, sizes, bits), "bucket long, keys binary, sets binary, owners binary")
    pairs = keys.groupBy("bucket").applyInArrow(_scan(bits), "chunk long, leaders binary, members binary")
    members = cut(pairs.groupBy("chunk").applyInArrow(_unite, "leader long, member long"))
    free_shuffles(spark)
    sketches = named.groupBy(F.col("set_id").alias("member")).agg(F.first("sketch").alias("packed"))
    near = components(meet(meetings(gathered(members), sets, SKETCH_TILES * TILE_SHINGLES).join(sketches, "member"), maybe_linked(percent)))
    members = cut(near.select(F.col("root").alias("leader"), F.col("node").alias("member")))
    free_shuffles(spark)
    to = meetings(members, sets, TILE_SHINGLES)
    targets = cut(to.select("member", "rep.doc_id", "rep.rows", "to"))
    n_targets, repeats = targets.agg(F.sum(F.size("to")), F.max("rows")).first()
    loaded = texts.join(small(targets.drop("rows"), n_targets or 0), "doc_id").select("member", "text", "to").mapInArrow(_load(n), "member long, n long, packed binary, to array<struct<leader: long, i: int, j: int, tile: int>>")
    if (repeats or 0) > 1:  # rows that share an id and a text
        loaded = loaded.dropDuplicates(["member"])
    stars = components(meet(loaded, linked(percent)))
    free_shuffles(spark)

    rooted = sets.join(stars, F.col("set_id") == F.col("node"), "left").select("set_id", "rep.doc_id", F.coalesce("root", "set_id").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = rooted.join(lowest, "root").select("set_id", "component_id")
    out = known.join(labels, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))
