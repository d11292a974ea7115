"""Mixing sources to target weights (operator 1).

Targets: the sources in code-point order (null last) weigh 5, 2, 1 in turn
and share 150 % of all words; a target stops at twice its source's words
and the excess is shared anew by weight.

Method.  A seeded hash places every document on its source's line, which is
cut into blocks (equal stretches of the hash range, about ``block_words``
words each).  A source's quota is exact: whole passes over all its blocks,
then the blocks of one more pass up to the document where the target is
reached, which is cut.  The blocks of all passes are permuted per source,
and a multivariate-hypergeometric splitting tree deals them to the output
shards: each node draws how many blocks of every source go to its left
half of the shards.  Node draws are seeded by the node, so every task finds
a block's shard by walking from the root; nothing but one row per source
reaches the driver (at most ``MAX_SOURCES``, else an error).  Inside a
shard, rows are ordered by a seeded hash.

Defined results: texts without words (null, empty) have size 0 and are
never drawn; null sources form one source; rows that repeat in every
mixed column share a cut evenly; no rows, no output.  Extra columns stay;
columns called like those added here are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import WORD, stored

MAX_SOURCES = 100_000
SPAN = 1 << 62
SEGMENT = 1024


def targets(sizes: list[int], weights=(5, 2, 1), percent: int = 150, cap: int = 2) -> list[float]:
    """Words to take from each source (water filling under the caps)."""
    left = percent * sum(sizes) / 100
    out = [0.0] * len(sizes)
    open_ = {i: weights[i % len(weights)] for i in range(len(sizes))}
    while open_:
        total = sum(open_.values())
        full = [i for i, w in open_.items() if left * w / total > cap * sizes[i]]
        if not full:
            for i, w in open_.items():
                out[i] = left * w / total
            break
        for i in full:
            out[i] = float(cap * sizes[i])
            del open_[i]
        left -= sum(out[i] for i in full)
    return out


class SplittingTree:
    """Shard of each block: ``counts`` blocks per source over ``shards``."""

    def __init__(self, counts, shards: int, seed: int):
        self.counts = np.asarray(counts, np.int64)
        self.shards, self.seed = shards, seed
        self.drawn: dict = {}

    def _left(self, lo: int, hi: int, counts: np.ndarray) -> np.ndarray:
        if (lo, hi) not in self.drawn:
            mid, n = (lo + hi) // 2, int(counts.sum())
            rng = np.random.default_rng([self.seed, lo, hi])
            got = rng.multivariate_hypergeometric(counts, n * (mid - lo) // (hi - lo), method="marginals") \
                if n else np.zeros_like(counts)
            if len(self.drawn) > 4096:
                self.drawn.clear()
            self.drawn[lo, hi] = got
        return self.drawn[lo, hi]

    def shard(self, source: np.ndarray, place: np.ndarray) -> np.ndarray:
        out = np.zeros(len(source), np.int64)
        todo = [(0, self.shards, self.counts, np.arange(len(source)), place.copy())]
        while todo:
            lo, hi, counts, rows, at = todo.pop()
            if not len(rows):
                continue
            if hi - lo == 1:
                out[rows] = lo
                continue
            left = self._left(lo, hi, counts)
            mine = left[source[rows]]
            go = at < mine
            mid = (lo + hi) // 2
            todo.append((lo, mid, left, rows[go], at[go]))
            todo.append((mid, hi, counts - left, rows[~go], (at - mine)[~go]))
        return out


def _block(u: str, n: str) -> Column:
    """Block of a place on the line: grows with the place."""
    return F.least(F.floor(F.col(u) * F.lit(1.0 / SPAN) * F.col(n)).cast("long"), F.col(n) - 1)


def _cuts(lines: DataFrame, need: DataFrame) -> dict:
    """Per source with a last part-pass: the place on its line where
    ``need`` words are reached, and the words for each row at that place.
    Blocks are summed by segment first, so no window holds a whole source."""
    blocks = stored(lines.join(F.broadcast(need), "sid").groupBy("sid", "need", "block")
                    .agg(F.sum("size").alias("w")), "mix-blocks")
    seg = F.floor(F.col("block") / SEGMENT)
    before = lambda c, *by: F.sum(c).over(Window.partitionBy(*by).orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    segs = blocks.groupBy("sid", "need", seg.alias("at")).agg(F.sum("w").alias("w")) \
        .withColumn("b0", F.coalesce(before("w", "sid"), F.lit(0))) \
        .filter("b0 < need and b0 + w >= need").select("sid", "need", F.col("at").alias("seg"), "b0")
    hit = blocks.withColumn("seg", seg).drop("need").join(F.broadcast(segs), ["sid", "seg"]) \
        .withColumn("at", F.col("block")) \
        .withColumn("b1", F.col("b0") + F.coalesce(before("w", "sid"), F.lit(0))) \
        .filter("b1 < need and b1 + w >= need").select("sid", "need", "block", "b1")
    rows = lines.join(F.broadcast(hit), ["sid", "block"]).groupBy("sid", "need", "block", "b1", "u") \
        .agg(F.sum("size").alias("w"), F.count("*").alias("n")).withColumn("at", F.col("u")) \
        .withColumn("b2", F.col("b1") + F.coalesce(before("w", "sid"), F.lit(0))) \
        .filter("b2 < need and b2 + w >= need")
    return {r.sid: (r.block, r.u, (r.need - r.b2) // r.n)
            for r in rows.select("sid", "need", "block", "u", "b2", "n").collect()}


def plan_mix(docs: DataFrame, weights=(5, 2, 1), percent: int = 150, cap: int = 2, seed: int = 11,
             block_words: int = 20_000, shard_words: int = 1_000_000,
             text_col: str = "text", source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The input rows with ``size``, ``source_size``, ``target``, ``taken``
    and ``draws``: array<struct<pass, shard, pos, words>>, one entry for
    each time the mix takes the document."""
    added = ["size", "source_size", "target", "taken", "draws"]
    docs = docs.drop(*[c for c in docs.columns if c in added])
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.xxhash64(text)), 2)
    name, has = F.coalesce(F.col(source_col).cast("string"), F.lit("")), F.col(source_col).isNotNull()
    lines = stored(docs.select(name.alias("name"), has.alias("has"), u.alias("u"), size.alias("size"))
                   .filter("size > 0"), "mix-lines")
    seen = docs.select(name.alias("name"), has.alias("has")).distinct().limit(MAX_SOURCES + 1) \
        .join(lines.groupBy("name", "has").agg(F.sum("size").alias("size")), ["name", "has"], "left").collect()
    if len(seen) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: weigh groups of sources instead")
    seen = sorted(((not r.has, r["name"], int(r["size"] or 0)) for r in seen))
    sizes = [s for _, _, s in seen]
    goal = targets(sizes, weights, percent, cap)
    passes = [int(g // s) if s else 0 for g, s in zip(goal, sizes)]
    part = [int(math.floor(g)) - p * s for g, p, s in zip(goal, passes, sizes)]
    n_blocks = [max(1, -(-s // block_words)) for s in sizes]
    kind = "sid int, name string, has boolean, source_size long, target double, passes int, need long, nb long"
    info = spark.createDataFrame(
        [(i, n, not null, s, g, p, r, b) for i, ((null, n, s), g, p, r, b) in
         enumerate(zip(seen, goal, passes, part, n_blocks))], kind)
    placed = lines.join(F.broadcast(info.select("sid", "name", "has", "nb")), ["name", "has"]) \
        .select("sid", "u", "size", _block("u", "nb").alias("block"))
    cuts = _cuts(placed, info.filter("need > 0").select("sid", "need"))
    last = [cuts.get(i, (-1, -1, 0)) for i in range(len(seen))]
    draws = [p * b + c[0] + 1 for p, b, c in zip(passes, n_blocks, last)]
    shards = max(1, -(-int(sum(goal)) // shard_words))
    info = spark.createDataFrame(
        [(i, n, not null, s, g, p, b, *c, d) for i, ((null, n, s), g, p, b, c, d) in
         enumerate(zip(seen, goal, passes, n_blocks, last, draws))],
        "sid int, name string, has boolean, source_size long, target double, passes int, nb long, "
        "cut_block long, cut_u long, cut_words long, n_draws long")
    deal = _dealer(draws, shards, seed)
    own = [c for c in info.columns if c not in ("source_size", "target")]
    info = info.withColumnsRenamed({c: f"__{c}" for c in own})
    rows = docs.select("*", size.alias("size"), u.alias("__u"), name.alias("__name"), has.alias("__has")) \
        .join(F.broadcast(info), ["__name", "__has"])
    rows = rows.withColumn("__block", _block("__u", "__nb"))
    extra = F.when(F.col("__u") < F.col("__cut_u"), F.col("size")) \
        .when(F.col("__u") == F.col("__cut_u"), F.col("__cut_words")).otherwise(F.lit(0))
    rows = rows.withColumn("__extra", extra.cast("long"))
    rows = rows.withColumn("taken", F.when(F.col("size") > 0, F.col("__passes") * F.col("size") + F.col("__extra")).otherwise(0).cast("long"))
    n = F.when(F.col("size") > 0, F.col("__passes") + (F.col("__extra") > 0).cast("int")).otherwise(0)
    turns = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("__turns", turns)
    rows = rows.withColumn("__shards", deal(F.col("__sid"), F.col("__block"), F.col("__nb"), F.size("__turns")))
    draw = F.transform("__turns", lambda t: F.struct(
        t.alias("pass"), F.get(F.col("__shards"), t).alias("shard"), F.xxhash64(F.lit(seed), t, F.col("__u")).alias("pos"),
        F.when(t < F.col("__passes"), F.col("size")).otherwise(F.col("__extra")).alias("words")))
    rows = rows.withColumn("draws", draw)
    return rows.select(*docs.columns, "size", "source_size", "target", "taken", "draws")


def _dealer(draws: list[int], shards: int, seed: int):
    """Column of the shard of each pass of a block: the block draws of a
    source are permuted (an affine bijection of their ranks) and the tree
    deals stretches of the permutation, so shards get disjoint blocks."""
    step = []
    for n in draws:
        a = int(n * 0.6180339887) | 1
        while math.gcd(a, max(n, 1)) != 1:
            a += 2
        step.append(a)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def deal(sid: pd.Series, block: pd.Series, nb: pd.Series, n: pd.Series) -> pd.Series:
        tree = SplittingTree(draws, shards, seed)
        turns = n.to_numpy(np.int64)
        row = np.repeat(np.arange(len(turns)), turns)
        first = np.cumsum(turns) - turns
        turn = np.arange(len(row)) - first[row]
        src = sid.to_numpy(np.int64)[row]
        rank = turn * nb.to_numpy(np.int64)[row] + block.to_numpy(np.int64)[row]
        total, by = np.asarray(draws, object), np.asarray(step, object)
        place = np.array([(r * by[s] + seed) % total[s] for r, s in zip(rank.tolist(), src.tolist())], np.int64)
        out = tree.shard(src, place)
        return pd.Series([out[f:f + t] for f, t in zip(first, turns)])

    return deal


def mix(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """One row per draw: the input columns, ``pass``, ``shard`` and ``pos``
    (the order inside a shard).  A document cut at its source's target holds
    its first words, joined by one space."""
    docs = docs.drop("pass", "shard", "pos")
    rows = plan_mix(docs, text_col=text_col, **options)
    rows = rows.select("*", F.explode("draws").alias("__d"))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)), F.lit(1), F.col("__d.words").cast("int")), " ")
    return rows.withColumn(text_col, F.when(F.col("__d.words") < F.col("size"), cut).otherwise(F.col(text_col))) \
        .select(*docs.columns, F.col("__d.pass").alias("pass"), F.col("__d.shard").alias("shard"), F.col("__d.pos").alias("pos"))


def write_mix(docs: DataFrame, path: str, **options) -> None:
    """Write the mix as Parquet, shard by shard, each in its shuffled order."""
    mix(docs, **options).repartition("shard").sortWithinPartitions("shard", "pos").write.parquet(path)
