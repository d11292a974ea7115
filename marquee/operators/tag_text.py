"""A movie's tag text as ordered chunks.

New tags are dealt by ranges of (movie, ts, event_id, tag), so a hot movie
lies in several partitions, each a later stretch of its tags.  A stretch is
cut into chunks of at most ``CHUNK_TAGS`` tags, joined by ``|`` in order;
the chunk's place is (partition, number in it), and positions in the whole
text are prefix sums over the chunks.  No task sorts or holds all tags of a
movie; only the finished text, which is the result, is one value.

Defined results: tags tie by (ts, event_id, tag), nulls first; null tags add
nothing, and a movie with no other tag has a null text; repeated rows are
all there; no rows, no chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_TAGS = 4096
CHUNK_CHARS = 1 << 16
_ORDER = ("ts", "event_id", "tag")


def _text(rows: Column, name: str) -> Column:
    """The values joined in order; null if there is none."""
    some = F.filter(F.transform(rows, lambda r: r[name]), lambda t: t.isNotNull())
    return F.when(F.size(some) > 0, F.array_join(some, "|"))


def tag_chunks(updates: DataFrame, size: int = CHUNK_TAGS, partitions: int | None = None) -> DataFrame:
    """(mid, part, chunk, n_tags, text) of tags (mid, tag, ts, event_id)."""
    partitions = partitions or updates.sparkSession.sparkContext.defaultParallelism
    dealt = updates.select("mid", *_ORDER).repartitionByRange(partitions, "mid", *_ORDER).withColumn("part", F.spark_partition_id())
    stretch = Window.partitionBy("part", "mid").orderBy(*_ORDER)
    rows = dealt.withColumn("chunk", F.floor((F.row_number().over(stretch) - 1) / size))
    listed = F.array_sort(F.collect_list(F.struct(*_ORDER)))
    return rows.groupBy("mid", "part", "chunk").agg(listed.alias("l"), F.count("tag").alias("n_tags")) \
        .select("mid", "part", "chunk", "n_tags", _text(F.col("l"), "tag").alias("text"))


def placed(chunks: DataFrame, order: tuple[str, ...] = ("part", "chunk")) -> DataFrame:
    """The chunks with ``start``, the position of their first character in
    the movie's text (from 0)."""
    before = Window.partitionBy("mid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return chunks.withColumn("start", F.coalesce(F.sum(F.length("text").cast("long") + 1).over(before), F.lit(0).cast("long")))


def merged(chunks: DataFrame, width: int = CHUNK_CHARS) -> DataFrame:
    """Logged chunks (with their batch ``v``), neighbours that start in the
    same ``width`` characters put together."""
    order = ("v", "part", "chunk")
    rows = placed(chunks, order).withColumn("wide", F.floor(F.col("start") / width))
    out = rows.groupBy("mid", "wide").agg(F.array_sort(F.collect_list(F.struct(*order, "text"))).alias("l"),
                                          F.sum("n_tags").alias("n_tags"))
    first = [F.get("l", F.lit(0))[c].alias(c) for c in order]
    return out.select("mid", *first, "n_tags", _text(F.col("l"), "text").alias("text")).select(*chunks.columns)


def joined(chunks: DataFrame, order: tuple[str, ...] = ("part", "chunk")) -> DataFrame:
    """(mid, add): the whole text of each movie."""
    listed = F.array_sort(F.collect_list(F.struct(*order, "text")))
    return chunks.groupBy("mid").agg(listed.alias("l")).select("mid", _text(F.col("l"), "text").alias("add"))


def extended(tags: Column, add: Column) -> Column:
    """``tags`` with ``add`` behind it."""
    return F.when(add.isNull(), tags).when(tags.isNull(), add).otherwise(F.concat_ws("|", tags, add))
