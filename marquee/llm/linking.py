"""Links and components for the near-duplicate operators.

Nothing here collects rows to the driver or emits all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b): comp is the smallest
    node of its component.  Distributed union-find by contraction: in each
    round every node joins its neighbour of least hash, and this one's choice
    in turn (hashes change by round, so long chains shrink by a constant
    factor too), then edges are rewritten to the roots.  The rounds' choices
    are put together at the end."""
    e = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "cc-edges")
    chain = []
    while not e.isEmpty():
        rank = lambda c, t=len(chain): F.struct(F.xxhash64(F.lit(t), F.col(c)).alias("h"), F.col(c).alias("id"))
        near = e.select(F.col("a").alias("node"), rank("b").alias("r")).union(e.select(F.col("b").alias("node"), rank("a").alias("r")))
        step = near.groupBy("node").agg(F.min("r").alias("r")) \
            .select("node", F.least(F.col("r"), rank("node")).getField("id").alias("root"))
        root = stored(_then(step, step), "cc-roots")
        chain.append(root)
        e = e.join(root.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a") \
            .join(root.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b") \
            .filter("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        e = stored(e, "cc-edges")
    if not chain:
        return e.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    labels = stored(reduce(_then, chain), "cc-labels")
    least = labels.groupBy("root").agg(F.min("node").alias("low"))
    return stored(labels.join(least, "root").select("node", F.least("root", "low").alias("comp")), "cc-components")


def _then(first: DataFrame, second: DataFrame) -> DataFrame:
    """(node, root): the root under ``second`` of each root under ``first``."""
    return first.join(second.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left") \
        .select("node", F.coalesce("up", "root").alias("root"))


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` (node, comp) with the components that ``links`` (x, y) join."""
    if labels is None:
        return components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    end = lambda c, to: labels.select(F.col("node").alias(c), F.col("comp").alias(to))
    edges = links.join(end("x", "cx"), "x", "left").join(end("y", "cy"), "y", "left") \
        .select(F.coalesce("cx", "x").alias("a"), F.coalesce("cy", "y").alias("b"))
    up = components(edges)
    old = labels.join(up.select(F.col("node").alias("comp"), F.col("comp").alias("up")), "comp", "left") \
        .select("node", F.coalesce("up", "comp").alias("comp"))
    return stored(old.unionByName(up.join(labels.select("node"), "node", "left_anti")), "link-labels")


def link_buckets(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], pair_ok: Callable[[str, str], Column],
                 hub_ok: Callable[[str, str], Column] | None = None, rounds: int = 2) -> DataFrame:
    """Components of the links among rows that share a bucket.

    ``buckets``: (bkt, rid, w, ...); ``verify`` keeps the pairs (x, y) that
    truly link; ``pair_ok('x', 'y')`` is a cheap condition on the struct
    columns x and y of two bucket rows that every link meets in some bucket;
    ``hub_ok`` is used instead for pairs with a hub, and may be looser.

    Copies of one text form large buckets whose members nearly all link to
    the same row.  So each bucket first compares its members with one hub
    (largest ``w``); members found linked share a component.  Later rounds
    take a hub outside the bucket's largest component.  A hub's own pairs
    are settled then, so it leaves the bucket, and buckets left with one
    component leave too; no pair is verified twice.  Last, every pair of a
    bucket that is still in two components is checked, which makes the
    result exact; only rows outside the largest component start a pair."""
    hub_ok = hub_ok or pair_ok
    rest, tried, labels = stored(buckets, "link-buckets"), None, None
    empty = rest.select(F.col("rid").alias("node"), F.col("rid").alias("comp")).limit(0)
    own = [c for c in rest.columns if c != "bkt"]
    for turn in range(rounds + 1):
        if turn:
            b = rest.withColumn("comp", F.col("rid")) if labels is None else \
                rest.join(labels.withColumnRenamed("node", "rid"), "rid", "left").withColumn("comp", F.coalesce("comp", "rid"))
            large = b.groupBy("bkt", "comp").agg(F.count("*").alias("n")) \
                .groupBy("bkt").agg(F.max_by("comp", F.struct("n", "comp")).alias("large"), F.count("*").alias("k")).filter("k > 1")
            rest = stored(b.join(large.drop("k"), "bkt"), "link-rest")
            if rest.isEmpty():
                break
            b = rest.select("bkt", "large", F.struct(*own, "comp").alias("y"))
            some = rest.filter("comp <> large")
            rest = rest.drop("comp", "large")
        else:
            b = rest.select("bkt", F.lit(None).cast("long").alias("large"), F.struct(*own, F.col("rid").alias("comp")).alias("y"))
            some = rest
        hub = some.groupBy("bkt").agg(F.max(F.struct("w", "rid")).getField("rid").alias("hub"))
        if turn < rounds:
            hubs = b.join(hub, "bkt").filter(F.col("y.rid") == F.col("hub")).select("bkt", F.col("y").alias("x"))
            pairs = b.join(hubs, "bkt").filter((F.col("x.comp") != F.col("y.comp")) & hub_ok("x", "y"))
            rest = rest.join(hub, "bkt").filter("rid <> hub").drop("hub")
        else:
            start = b.filter("y.comp <> large").select("bkt", F.col("y").alias("x"))
            pairs = start.join(b, "bkt").filter((F.col("x.comp") != F.col("y.comp")) & pair_ok("x", "y")
                                                & ((F.col("y.comp") == F.col("large")) | (F.col("x.rid") < F.col("y.rid"))))
        pairs = pairs.select(F.least("x.rid", "y.rid").alias("x"), F.greatest("x.rid", "y.rid").alias("y")).distinct()
        pairs = stored(pairs if tried is None else pairs.join(tried, ["x", "y"], "left_anti"), "link-pairs")
        tried = pairs if tried is None else tried.unionAll(pairs)
        found = stored(verify(pairs), "links")
        if not found.isEmpty():
            labels = _merged(labels, found)
    return empty if labels is None else labels
