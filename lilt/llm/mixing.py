"""Mixing sources to target weights by systematic sampling (DataFrame operations only).

Each document of a source is expected ``target / source_size`` times in the mix. Documents of a source stand in
a fixed order (size class, bucket, id); the prefix sum of the expected copies plus one random offset of the
source crosses integers, and a document is taken once for each integer that its own step crosses.

The prefix sum has three levels, so a source that holds a third of all rows is never one task's: ranks inside
(source, class, bucket), offsets of a class's buckets (at most ``buckets`` rows), offsets of a source's classes (a
few hundred rows). Neighbours in the order have sizes within about 6 % of each other, so the words taken come
near the target, not only the documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lilt.llm.common import WORD, cut, source_key


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hexadecimal(text: Column) -> Column:
    """The first five hexadecimal digits of a text's MD5 as a number: below 2 ** 20."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 5), 16, 10).cast("long")


def size_class(size: str) -> Column:
    """Integer class of a size, monotone in it: its bit length and the four bits after the first."""
    return F.expr(f"cast(length(bin({size})) * 16 + (shiftright({size}, cast(greatest(length(bin({size})) - 5, 0) as int)) & 15) as int)")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, max_ratio: int = 3) -> DataFrame:
    """Per source: its size, target and expected copies of a document.

    sizes: (_key, _size), any number of rows a source. Sources in code-point order, null last, weigh ``weights``,
    repeating. A target stops at ``max_ratio`` times its source's size and the excess is reshared by weight. With
    sources sorted by cap / weight, the level that the rest shares when the first k are capped is
    (total - their caps) / (the others' weights); the sum of min(level * weight, cap) is concave in the level, so
    the right level is the largest of these. One row per source passes through these windows.
    """
    every = Window.partitionBy(F.lit(0))
    rank = Window.partitionBy(F.lit(0)).orderBy("_key")
    before = Window.partitionBy(F.lit(0)).orderBy("_ratio", "_key").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.row_number().over(rank) - 1) % len(weights) + 1)
    return (
        sizes.groupBy("_key")
        .agg(F.sum("_size").alias("_source_size"))
        .withColumn("_weight", weight)
        .withColumn("_cap", F.col("_source_size") * max_ratio)
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_goal", F.sum("_source_size").over(every) * F.lit(float(share)))
        .withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_others", F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0)))
        .withColumn("_level", F.max((F.col("_goal") - F.col("_capped")) / F.col("_others")).over(every))
        .withColumn("_target", F.least(F.col("_level") * F.col("_weight"), F.col("_cap").cast("double")))
        .withColumn("_rate", F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0))
        .select("_key", "_source_size", "_target", "_rate")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    share: float = 1.0,
    max_ratio: int = 3,
    seed: str = "mix",
    buckets: int = 256,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """docs with a column ``mix``: struct(size, source_size, target, copies).

    Every input row returns once, repeated rows and rows with a null id included; ``copies`` says how often the mix
    takes it (0 to max_ratio). A null text has size 0; a null source is a source of its own, the last. Reruns agree:
    the order and the offsets depend on the rows and the seed alone. Whole texts count, whatever their length. An input column
    named ``mix`` is replaced, all others return unchanged, whatever their names; an empty table gives an empty table. A source
    whose sizes are all 0 has target 0 and no copies.
    """
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "mix"]).alias("row"),
        F.col(id_col).alias("id"),
        source_key(F.col(source_col)).alias("_key"),
        word_count(F.col(text_col)).alias("_size"),
    )
    base = base.withColumn("_class", size_class("_size")).withColumn("_bucket", F.coalesce(hexadecimal(F.col("id").cast("string")) % int(buckets), F.lit(0)))
    group = ["_key", "_class", "_bucket"]
    # at most ``buckets`` rows for each of a source's size classes; read three times below
    counts = cut(base.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_size")))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    in_class = counts.withColumn("_in_class", F.coalesce(F.sum("_n").over(before(Window.partitionBy("_key", "_class").orderBy("_bucket"))), F.lit(0)))
    classes = counts.groupBy("_key", "_class").agg(F.sum("_n").alias("_n"), F.sum("_size").alias("_size"))
    offset = hexadecimal(F.concat(F.lit(seed), "_key")).cast("double") / F.lit(1048576.0)
    per_class = (
        classes.withColumn("_before", F.coalesce(F.sum("_n").over(before(Window.partitionBy("_key").orderBy("_class"))), F.lit(0)))
        .select("_key", "_class", "_before")
        .join(source_targets(classes.select("_key", "_size"), weights, share, max_ratio), "_key")
        .withColumn("_offset", offset)
    )
    starts = in_class.select(*group, "_in_class").join(per_class, ["_key", "_class"])
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("id", "_size"))
    k = F.col("_before") + F.col("_in_class") + F.col("_rank")
    crossed = F.floor(k * F.col("_rate") + F.col("_offset")) - F.floor((k - 1) * F.col("_rate") + F.col("_offset"))
    # a step is at most max_ratio long; least() only guards the last bit of the products
    mixed = F.struct(
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.least(crossed, F.lit(int(max_ratio)).cast("long")).alias("copies"),
    )
    return base.withColumn("_rank", rank).join(starts, group).select(*[F.col(f"row.`{c}`") for c in docs.columns if c != "mix"], mixed.alias("mix"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of docs as often as mix() takes it, with the columns of docs."""
    mixed = mix(docs, **options)
    taken = mixed.where(F.col("mix.copies") > 0).select(F.struct(*[F.col(f"`{c}`") for c in mixed.columns if c != "mix"]).alias("row"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix.copies"))).alias("copy"))
    return taken.select(*[F.col(f"row.`{c}`") for c in docs.columns if c != "mix"])
