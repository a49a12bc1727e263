"""Exact top-k search by inner product: norm-bucketed retrieval with local cosine thresholds.

Vectors are grouped by length into buckets on a logarithmic scale, and a bucket is dealt into blocks of bounded size, so a
length that a third of all vectors have is many blocks. A query's k-th best score so far divided by its length and a block's
greatest length is the cosine that a vector of the block must reach. Above 1 the block is skipped. Where it is high,
coordinate pruning is chosen: sorted lists of the query's largest coordinates give the few vectors whose coordinates can reach
the cosine. Else length pruning: the prefix of the block, sorted by length, that can reach the score. What is left
is verified by exact integer products.

First thresholds come from a bounded seed, the longest vectors. Queries come in groups and blocks in slots, both of bounded
size, and each pair of them meets in one task: the stated query set runs against all rows in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lilt.llm.common import bounded_batches, cut

#: Vectors in a block, blocks in a slot, queries in a group, vectors of the seed, local cosine from which coordinates prune.
BLOCK, SLOT_BLOCKS, GROUP, SEED, COORDINATE_FROM, FOCUS = 4096, 4, 4096, 1024, 0.6, 3


def usable(vector: Column) -> Column:
    """True for a vector that isn't null and has only finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def quantize(vectors: list[list[float]], scale: int) -> np.ndarray:
    """floor(scale * x) of components taken as doubles."""
    return np.floor(np.array(vectors, np.float64) * scale)


def length_bucket(vector: Column, scale: int) -> Column:
    """Bucket of a vector's length: 16 for each doubling, at most 2,048 of them."""
    square = F.aggregate(vector, F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * scale).cast("double"), 2))
    return F.least(F.floor(F.log2(square + 1) * 8), F.lit(2047)).cast("int")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows: in doubles while these are exact, else in 64-bit integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)))
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2**53:
        return a @ b.T
    return a.astype(np.int64) @ b.astype(np.int64).T


class Block:
    """Vectors of one dimension in descending order of length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        lengths = np.linalg.norm(vectors, axis=1)
        order = np.argsort(-lengths, kind="stable")
        self.ids, self.vectors, self.lengths = ids[order], vectors[order], lengths[order]
        self.unit = self.vectors / np.maximum(self.lengths, 1e-300)[:, None]
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def by_coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.sorted:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.sorted[f] = order, self.unit[order, f]
        return self.sorted[f]

    def near(self, query: np.ndarray, cosine: float) -> np.ndarray:
        """Places of the vectors whose coordinates allow that cosine with a unit query, by FOCUS of its coordinates."""
        spans = []
        for f in np.argsort(-np.abs(query))[:FOCUS].tolist():
            q = min(1.0, max(-1.0, float(query[f])))
            spread = ((1 - q * q) * (1 - cosine * cosine)) ** 0.5
            low = -1.0 if q <= -cosine else q * cosine - spread
            high = 1.0 if q >= cosine else q * cosine + spread
            order, values = self.by_coordinate(f)
            a, b = np.searchsorted(values, [low - 1e-9, high + 1e-9])
            spans.append((b - a, f, low, high, order[a:b]))
        spans.sort(key=lambda s: s[0])
        found = spans[0][4]
        for _, f, low, high, _ in spans[1:]:
            x = self.unit[found, f]
            found = found[(x >= low - 1e-9) & (x <= high + 1e-9)]
        return found


class Best:
    """The k best (score, id) of each query so far, ties to the smaller id, and the thresholds they set."""

    def __init__(self, queries: int, k: int, floor: np.ndarray) -> None:
        self.k, self.floor = k, floor
        self.query, self.score, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        q, s, i = np.concatenate([self.query, query]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        first = np.searchsorted(q, q, side="left")
        rank = np.arange(len(q)) - first
        full = rank == self.k - 1
        self.floor[q[full]] = np.maximum(self.floor[q[full]], s[full])
        keep = rank < self.k
        self.query, self.score, self.id = q[keep], s[keep], i[keep]


def search(query_ids: np.ndarray, queries: np.ndarray, blocks: list[Block], k: int, floor: np.ndarray) -> Best:
    """The k best of some blocks for each query; scores below floor, a lower bound of the k-th best, may be missing."""
    best = Best(len(queries), k, floor.copy())
    lengths = np.linalg.norm(queries, axis=1)
    for block in sorted(blocks, key=lambda b: -float(b.lengths[0])):
        reach = lengths * block.lengths[0]
        alive = np.flatnonzero(best.floor <= reach * (1 + 1e-9) + 1e-9)
        cosine = np.where(reach[alive] > 0, best.floor[alive] / np.maximum(reach[alive], 1e-300), -1.0)
        by_coordinate = cosine >= COORDINATE_FROM
        for at in range(0, int((~by_coordinate).sum()), 256):
            part = alive[~by_coordinate][at : at + 256]
            need = np.min(np.where(lengths[part] > 0, best.floor[part] / np.maximum(lengths[part], 1e-300), -np.inf)) - 1e-6
            prefix = int(np.searchsorted(-block.lengths, -need, side="right"))
            scores = products(queries[part], block.vectors[:prefix])
            r, c = np.nonzero((scores >= best.floor[part][:, None]) & (block.ids[None, :prefix] != query_ids[part][:, None]))
            best.add(part[r], scores[r, c].astype(np.float64), block.ids[c])
        rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for q, t in zip(alive[by_coordinate].tolist(), cosine[by_coordinate].tolist(), strict=True):
            found = block.near(queries[q] / lengths[q], min(1.0, t))
            found = found[block.ids[found] != query_ids[q]]
            scores = products(queries[q : q + 1], block.vectors[found])[0]
            ok = scores >= best.floor[q]
            rows.append((np.full(int(ok.sum()), q), scores[ok].astype(np.float64), block.ids[found[ok]]))
        if rows:
            best.add(*(np.concatenate(c) for c in zip(*rows, strict=True)))
    return best


def _packed(table: pa.Table, scale: int) -> list[tuple[int, bytes, bytes]]:
    """(dimension, ids, components) of a table's vectors, by dimension."""
    ids, vectors = table.column("vec_id").to_pylist(), table.column("vector").to_pylist()
    out = []
    for d in sorted({len(v) for v in vectors} - {0}):
        own = [j for j, v in enumerate(vectors) if len(v) == d]
        x = quantize([vectors[j] for j in own], scale)
        kind = next((t for t in ("<i2", "<i4") if np.abs(x).max() < np.iinfo(t).max), "<f8")
        out.append((d, np.array([ids[j] for j in own], "<i8").tobytes(), kind.encode() + x.astype(kind).tobytes()))
    return out


def _opened(d: int, ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(data, data[:3].decode(), offset=3).reshape(-1, d).astype(np.float64)


_PACK = pa.schema([("part", pa.int64()), ("d", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())])


def _pack(part: str, scale: int):
    def run(table: pa.Table) -> pa.Table:
        own = table.column(part)[0].as_py()
        return pa.Table.from_pylist([{"part": own, "d": d, "ids": i, "data": x} for d, i, x in _packed(table, scale)], schema=_PACK)

    return run


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k greatest integer inner products, ties to the smaller vec_id.

    Components count as floor(scale * x). Candidates are all rows but those with the query's own id; fewer than k
    candidates give fewer rows. Null ids and vectors that are null, empty or hold a null or non-finite component take no
    part, and vectors of different dimensions have no score. Repeated query ids are one query, with the
    smallest of their vectors; repeated candidate rows are candidates each. Scores are exact up to 2 ** 63. Other columns
    don't matter. Without usable rows the result is empty.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    pick = lambda df: df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")).where(F.col("vec_id").isNotNull() & usable(F.col("vector")) & (F.size("vector") > 0))
    all_rows = pick(vectors).withColumn("bucket", length_bucket(F.col("vector"), scale))
    asked = pick(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))

    # one row for each of at most 2,048 buckets: bounded, so it can be sent to all tasks
    counts = all_rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select("bucket", F.expr(f"cast(ceil(n / {BLOCK}) as int)").alias("blocks"))
    dealt = all_rows.join(F.broadcast(counts), "bucket").withColumn("block", F.expr(f"bucket * {1 << 40} + pmod(xxhash64(vec_id), blocks)"))
    blocks = cut(dealt.groupBy("block").applyInArrow(_pack("block", scale), "part long, d int, ids binary, data binary"))
    n_blocks, n_queries = blocks.count(), asked.count()
    slots, groups = max(1, -(-n_blocks // SLOT_BLOCKS)), max(1, -(-n_queries // GROUP))
    grouped = asked.withColumn("grp", F.expr(f"pmod(xxhash64(vec_id), {groups})"))
    packed = cut(grouped.groupBy("grp").applyInArrow(_pack("grp", scale), "part long, d int, ids binary, data binary"))

    seed_rows = all_rows.orderBy(F.col("bucket").desc(), "vec_id").limit(SEED).select("vec_id", "vector").toArrow()
    seed = _packed(seed_rows, scale)

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for q in right.to_pylist():
            ids, x = _opened(q["d"], q["ids"], q["data"])
            own = [Block(*_opened(b["d"], b["ids"], b["data"])) for b in left.to_pylist() if b["d"] == q["d"]]
            if not own:
                continue
            floor = np.full(len(ids), -np.inf)
            for d, i, data in seed:
                if d == q["d"]:
                    floor = search(ids, x, [Block(*_opened(d, i, data))], k, floor).floor
            best = search(ids, x, own, k, floor)
            out.append(pa.table([pa.array(ids[best.query]), pa.array(best.id), pa.array(best.score.astype(np.int64))], schema=_FOUND))
        return pa.concat_tables(out) if out else _FOUND.empty_table()

    left = blocks.withColumn("slot", F.expr(f"pmod(xxhash64(part, d), {slots})")).withColumn("grp", F.explode(F.expr(f"sequence(0, {groups - 1})")))
    right = packed.withColumn("grp", F.col("part").cast("int")).withColumn("slot", F.explode(F.expr(f"sequence(0L, {slots - 1}L)")))
    found = left.groupBy("grp", "slot").cogroup(right.groupBy("grp", "slot")).applyInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
