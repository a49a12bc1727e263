"""Exact percentiles of groups of any size, hot ones included.

A percentile's aggregate holds a map of all values of a group, and one task reads those of all others. Here the ranks that
the percentiles need are narrowed down instead: each pass counts the values of the intervals that hold a rank by PARTS equal
parts, until an interval has one value or at most FEW rows, whose values are then counted one by one. A task so reads counts,
at most PARTS + 2 for each interval and task before it or FEW at the end, however many rows a group has.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts of an interval, rows of one whose values are counted one by one, passes after which all are.
PARTS, FEW, PASSES = 1000, 200_000, 12
#: Rows that may be broadcast once they have been counted.
BROADCAST_ROWS = 250_000
#: Bounds whose difference is finite; values beyond fall into the first or last part.
WIDEST = 8e307


def once(df: DataFrame) -> DataFrame:
    """df, computed now and only once: in the session's checkpoint folder, on the executors if it names none."""
    sc, named = df.sparkSession.sparkContext, df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if named and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return df.checkpoint() if sc.getCheckpointDir() else df.localCheckpoint()


def small(df: DataFrame, rows: int) -> DataFrame:
    """df, which has that many rows, marked for broadcasting if they are few: what it is joined with then isn't dealt by key."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def part(v: Column, lo: Column, hi: Column) -> Column:
    """The number, from 0 to PARTS + 1, of v's part of lo to hi, monotone in v; lo and hi themselves have the first and the last."""
    a, b = F.greatest(lo, F.lit(-WIDEST)), F.least(hi, F.lit(WIDEST))
    share = F.coalesce(F.try_divide(F.least(v, b) - a, b - a), F.lit(0.0))
    inner = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * (PARTS - 1)
    return F.when(v == lo, 0).when(v == hi, PARTS + 1).otherwise(F.floor(inner).cast("int") + 1)


def _same(keys: Sequence[str], a: DataFrame, b: DataFrame) -> Column:
    """Equal keys of a, named a, and b, named b; null equals null."""
    each = [(F.col(f"a.{k}"), F.col(f"b.{k}"), a.schema[k].nullable or b.schema[k].nullable) for k in keys]
    return reduce(lambda x, y: x & y, [x.eqNullSafe(y) if null else x == y for x, y, null in each])


def _narrowed(rows: DataFrame, keys: list[str], members: DataFrame, ranks: DataFrame, n_ranks: int, whole: bool) -> DataFrame:
    """ranks, all of open intervals, with the part, or the value (whole), of their interval that holds them."""
    bounds = once(members.join(small(ranks.select("id", "lo", "hi").distinct(), n_ranks), "id"))
    inside = rows.alias("a").join(small(bounds, bounds.count()).alias("b"), _same(keys, rows, bounds) & F.col("v").between(F.col("lo"), F.col("hi")))
    at = F.col("v") if whole else part(F.col("v"), F.col("lo"), F.col("hi"))
    counted = inside.select("id", F.col("lo").alias("of"), at.alias("at"), "v").groupBy("id", "of", "at").agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("first"), F.max("v").alias("last"))
    ends = counted.withColumn("until", F.sum("m").over(Window.partitionBy("id", "of").orderBy("at")))
    before = F.col("before") + F.col("until") - F.col("m")
    holds = (F.col("a.id") == F.col("b.id")) & (F.col("of") == F.col("lo")) & (F.col("rank") >= before) & (F.col("rank") < before + F.col("m"))
    found = ends.alias("a").join(small(ranks, n_ranks).alias("b"), holds)
    return found.select("b.id", "rank", before.alias("before"), F.col("first").alias("lo"), F.col("last").alias("hi"), F.col("m").alias("size"))


def percentiles(rows: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], least: int = 1, pooled: Sequence[str] | None = None) -> DataFrame:
    """(keys, pool, n, cuts): a row for each group with its number of values and the values at the shares (0 to 1), interpolated.

    Nulls aren't values; NaN is the largest one. cuts is null for a group of fewer than ``least`` values. With ``pooled``, some
    of the keys, groups alike in these have a row together too; its pool is true, its other keys are null. rows is read once
    for each pass, and passes run at once: three do for groups of any size if outliers don't stretch them.
    """
    keys = list(keys)
    rows = rows.select(*keys, F.col(value).cast("double").alias("v"))
    single = once(rows.groupBy(*keys).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    groups = single.select(F.lit(False).alias("pool"), "*")
    if pooled is not None:
        pools = single.groupBy(*pooled).agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        groups = groups.unionByName(pools.withColumn("pool", F.lit(True)), allowMissingColumns=True)
    groups = once(groups.withColumn("id", F.monotonically_increasing_id()))
    members = groups.where("NOT pool").select(*keys, "id")
    if pooled is not None:
        pools = groups.where("pool").select(*pooled, "id")
        members = members.unionByName(single.alias("a").join(pools.alias("b"), _same(pooled, single, pools)).select(*[f"a.{k}" for k in keys], "id"))
    place = lambda q: (F.col("n") - 1) * F.lit(float(q))
    below, above = (lambda q: F.floor(place(q))), (lambda q: F.ceil(place(q)))
    wanted = F.explode(F.array_distinct(F.array(*[f(q) for q in shares for f in (below, above)])))
    ranks = groups.where(F.col("n") >= max(least, 1)).select("id", wanted.alias("rank"), F.lit(0).cast("long").alias("before"), "lo", "hi", F.col("n").alias("size"))
    done = []
    for i in range(PASSES):
        done.append(ranks.where("lo = hi"))
        ranks = ranks.where("lo < hi")
        left = ranks.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size")).first()
        if not left["n"]:
            break
        whole = left["size"] <= FEW or i == PASSES - 1
        ranks = once(_narrowed(rows, keys, members, ranks, left["n"], whole))
        if whole:
            done.append(ranks)
            break
    values = reduce(DataFrame.unionByName, done).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("rank", "lo"))).alias("at"))

    def cut(q: float) -> Column:
        low, high = F.try_element_at("at", below(q)), F.try_element_at("at", above(q))
        return F.when(low == high, low).otherwise((above(q) - place(q)) * low + (place(q) - below(q)) * high)

    cuts = F.when(F.col("at").isNotNull(), F.array(*[cut(q) for q in shares]))
    return groups.join(values, "id", "left").select(*keys, "pool", "n", cuts.alias("cuts"))
