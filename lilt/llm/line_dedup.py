"""Line deduplication across documents (DataFrame operations only).

Long lines become 128-bit hashes. Rows of (hash, document, position) are dealt to ranges of the hash and sorted inside by hash,
document and position; a window streams each hash's run in this order: its first row is of the largest document, which keeps
the line, and the documents of the run are counted. What comes back is a compressed keep bitmap per document, never text: only
the 64-bit words of the bitmap that drop a line are listed.

A hash that would fill much of a range is split over several by its documents. Such hashes are found in a sample of the rows,
which balances the ranges and decides nothing else; the parts of a split hash are settled by one row of each part. The rows are
exchanged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lilt.llm.common import BLANKS, ascii_lower, cut, partitions, small

#: Rows of a task, ranges of a task, rows of the sample that balances the ranges.
TASK_ROWS, RANGES, SAMPLE = 1_000_000, 8, 1_000_000


def split_lines(text: Column) -> Column:
    """The lines of a text; null and the empty text are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """What makes two lines equal: stripped of ASCII white space, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def ranged(hashed: DataFrame, rows: int) -> DataFrame:
    """hashed (h1, h2, doc, pos), which has that many rows, with ``range`` and ``parts``: dealt to ranges and sorted inside.

    h1 is uniform, so equal parts of its values are equal ranges. A hash that holds more than two ranges' share of the rows is
    dealt by document to ``parts`` neighbouring ranges; at most half as many hashes as ranges can be such, so they are broadcast.
    """
    tasks = partitions(hashed.sparkSession, rows, TASK_ROWS)
    ranges = tasks * RANGES
    thin = max(1, rows // SAMPLE)
    counted = hashed.where(F.pmod(F.xxhash64("doc", "pos"), F.lit(thin)) == 0).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    share = max(1.0, rows / ranges)
    hot = counted.where(F.col("n") * thin > 2 * share).select("h1", "h2", F.least(F.ceil(F.col("n") * thin / share), F.lit(ranges)).cast("int").alias("parts"))
    own = F.floor((F.col("h1").cast("double") / 2.0**64 + 0.5) * ranges)
    place = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("doc"), F.col("parts"))).otherwise(F.lit(0))
    dealt = hashed.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn("range", F.pmod(own + place, F.lit(ranges)).cast("int"))
    return dealt.repartitionByRange(tasks, "range").sortWithinPartitions("range", "h1", "h2", F.col("doc").desc(), "pos")


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, words array<struct<word long, bits long>>): bit i of word w is set if line 64 * w + i is dropped.

    A key of at least min_chars code points found in at least min_docs documents loses its lines in all documents but
    the largest id. Documents and bitmap words without a dropped line are absent. Rows with a null id neither count nor
    lose lines; rows that share an id count as one document. An empty table, or one without long lines, gives no rows.
    """
    line = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.posexplode(split_lines(F.col(text_col))).alias("pos", "line"))
    long = line.select("doc", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    hashed = cut(long.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc", "pos"))
    run = Window.partitionBy("range", "h1", "h2")
    stream = run.orderBy(F.col("doc").desc(), "pos")
    so_far = stream.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first, before = F.first("doc").over(so_far), F.lag("doc").over(stream)
    told = ranged(hashed, hashed.count()).withColumns({"keeper": first, "fresh": F.when(before == F.col("doc"), 0).otherwise(1), "lead": before.isNull()})
    told = told.withColumn("docs", F.sum("fresh").over(run))
    edges = told.where("parts IS NOT NULL AND lead").groupBy("h1", "h2").agg(F.max("keeper").alias("top"), F.sum("docs").alias("all"))
    settled = told.where("parts IS NULL").select("doc", "pos", "keeper", "docs").union(
        told.where("parts IS NOT NULL").join(F.broadcast(edges), ["h1", "h2"]).select("doc", "pos", "top", "all")
    )
    dropped = settled.where((F.col("docs") >= min_docs) & (F.col("doc") != F.col("keeper")))
    words = dropped.groupBy("doc", F.expr("cast(pos div 64 as long)").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pos % 64 as int))")).alias("bits"))
    return words.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with its text reduced to the kept lines and a column ``lines``: struct(n_lines, n_dropped).

    Every input row returns. A text that loses nothing, null included, is returned as it is; one that loses all its
    lines becomes the empty text. Rows with a null id lose nothing; rows that share an id lose the positions that any of them
    loses. Whole texts count, whatever their length; an empty table gives an empty table. An input column named ``lines`` is
    replaced, all others return unchanged, whatever their names.

    Bitmaps are broadcast to the documents if they are few, so that texts stay where they are.
    """
    bitmaps = cut(keep_bitmaps(docs, min_chars, min_docs, id_col, text_col))
    n = bitmaps.agg(F.sum(F.size("words"))).first()[0] or 0
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "lines"]).alias("row"), F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    joined = rows.join(small(bitmaps, n), "doc", "left").withColumn("split", split_lines(F.col("text")))
    dense = F.expr("transform(sequence(0L, (size(split) - 1) div 64), w -> coalesce(map_from_entries(words)[w], 0L))")
    joined = joined.withColumn("dense", F.when(F.col("words").isNotNull(), dense))
    kept = F.expr("array_join(filter(split, (x, i) -> (shiftright(dense[cast(i div 64 as int)], i % 64) & 1) = 0), '\n')")
    text = F.when(F.col("words").isNull(), F.col("text")).otherwise(kept)
    n_dropped = F.coalesce(F.expr("aggregate(words, 0L, (n, w) -> n + bit_count(w.bits))"), F.lit(0).cast("long"))
    stats = F.struct(F.size("split").cast("long").alias("n_lines"), n_dropped.alias("n_dropped"))
    columns = [text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns if c != "lines"]
    return joined.select(*columns, stats.alias("lines"))
