"""Connected components over a table of links, without bringing any to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lilt.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of links (a, b), the smallest node of its component.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until the edges form stars; each round's edges are
    written to the shared checkpoint folder. Smallest neighbours are combined on the map side and joined back by
    sort-merge joins, so a hub with very many neighbours can be split. Self-links, nulls and repeated links are ignored.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v")).distinct()
        before = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.union(lower.select("u", F.col("m").alias("v"))).distinct())
