"""Item-to-item cosine similarity (P6, P17, J4, M5, A7) and blocked
top-k scoring of one factor set against another (used by M3).

All-pairs similarity is computed as a blocked matrix product:

1. items get a block number ``pmod(xxhash64(id), B)``; ``B`` is chosen from
   one count so that a block holds about ``block_rows`` items.  Ids are
   unique, so blocks are balanced whatever the id distribution;
2. each block becomes one row (ids array + row-major factor matrix);
3. every block is emitted once per block pair it belongs to, keyed by the
   pair ``(bi, bj)`` with ``bi <= bj``, and the two sides are joined on
   that key -- each key has exactly one row per side, so the join is
   balanced and no cartesian product is planned;
4. ``mapInPandas`` multiplies the two blocks with numpy (BLAS) and emits
   only pairs above the threshold, in both directions.

The shuffle volume is the factor table times ``B``; the work per task is
bounded by two blocks.  Nothing passes through the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.columns import sort_recs
from marquee.operators.factor_blocks import pairs_of, similar_pairs, top_products, usable, whole_lists
from marquee.schemas import RECS

SIM_SCHEMA = T.StructType([
    T.StructField("mid", T.IntegerType()),
    T.StructField("sim_mid", T.IntegerType()),
    T.StructField("sim", T.DoubleType()),
])


def num_blocks(n_items: int, block_rows: int) -> int:
    return max(1, math.ceil(n_items / max(1, block_rows)))


def to_blocks(factors: DataFrame, id_col: str, feat_col: str, nblocks: int) -> DataFrame:
    """One row per block: (blk, ids ARRAY<INT>, mat ARRAY<DOUBLE>, dim)."""
    f = factors.select(F.col(id_col).cast("int").alias("id"),
                       F.col(feat_col).cast("array<double>").alias("v"))
    f = f.withColumn("blk", F.pmod(F.xxhash64("id"), F.lit(nblocks)).cast("int"))
    items = F.collect_list(F.struct("id", "v"))
    return (f.groupBy("blk").agg(items.alias("items"))
            .select("blk",
                    F.transform("items", lambda x: x["id"]).alias("ids"),
                    F.flatten(F.transform("items", lambda x: x["v"])).alias("mat"),
                    F.size(F.element_at("items", 1)["v"]).alias("dim")))


def pair_partitions(spark, n_pairs: int) -> int:
    """Partitions for block-pair tasks: one per pair up to 4 x the cluster's
    cores.  The count is explicit, so AQE does not merge the (byte-small
    but compute-heavy) pair rows into a few tasks."""
    return max(1, min(2 * n_pairs, 4 * spark.sparkContext.defaultParallelism))


def co_partition(a: DataFrame, b: DataFrame, n_pairs: int):
    """Hash-partition both join sides on (bi, bj) with the same explicit
    count; the join then reuses this partitioning (no further exchange)."""
    p = pair_partitions(a.sparkSession, n_pairs)
    return a.repartition(p, "bi", "bj"), b.repartition(p, "bi", "bj")


def block_pairs(blocks_a: DataFrame, blocks_b: DataFrame, nb_a: int, nb_b: int,
                upper: bool) -> DataFrame:
    """Join blocks into pair rows keyed by (bi, bj).

    ``upper=True`` (a set against itself) keeps bi <= bj only.
    """
    a = blocks_a.select(F.col("blk").alias("bi"),
                        F.explode(F.sequence(F.col("blk") if upper else F.lit(0), F.lit(nb_b - 1))).alias("bj"),
                        F.col("ids").alias("ids_a"), F.col("mat").alias("mat_a"), F.col("dim").alias("dim_a"))
    b = blocks_b.select(F.explode(F.sequence(F.lit(0), F.col("blk") if upper else F.lit(nb_a - 1))).alias("bi"),
                        F.col("blk").alias("bj"),
                        F.col("ids").alias("ids_b"), F.col("mat").alias("mat_b"), F.col("dim").alias("dim_b"))
    n_pairs = nb_a * (nb_a + 1) // 2 if upper else nb_a * nb_b
    a, b = co_partition(a, b, n_pairs)
    return a.join(b, ["bi", "bj"])


def _matrix(ids, mat, dim):
    ids = np.asarray(ids, dtype=np.int64)
    m = np.asarray(mat, dtype=np.float64)
    if len(ids) == 0:
        return ids, np.zeros((0, int(dim or 0)))
    return ids, m.reshape(len(ids), -1)


def _cosine_pairs(threshold: float):
    def run(batches):
        for pdf in batches:
            outs = []
            for r in pdf.itertuples(index=False):
                ia, a = _matrix(r.ids_a, r.mat_a, r.dim_a)
                ib, b = _matrix(r.ids_b, r.mat_b, r.dim_b)
                if len(ia) == 0 or len(ib) == 0:
                    continue
                na = np.linalg.norm(a, axis=1)
                nb = np.linalg.norm(b, axis=1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    s = (a @ b.T) / np.outer(na, nb)
                keep = s > threshold          # NaN (zero vectors) compare False
                if r.bi == r.bj:
                    np.fill_diagonal(keep, False)
                x, y = np.nonzero(keep)
                if len(x) == 0:
                    continue
                vals = s[x, y]
                outs.append(pd.DataFrame({"mid": ia[x], "sim_mid": ib[y], "sim": vals}))
                if r.bi != r.bj:
                    outs.append(pd.DataFrame({"mid": ib[y], "sim_mid": ia[x], "sim": vals}))
            if outs:
                out = pd.concat(outs, ignore_index=True)
                yield out.astype({"mid": "int32", "sim_mid": "int32", "sim": "float64"})
    return run


def item_similarity(factors: DataFrame, threshold: float = 0.6, id_col: str = "mid",
                    feat_col: str = "features", block_rows: int = 2048,
                    n_items: int | None = None, of: DataFrame | None = None,
                    whole: bool = False) -> DataFrame:
    """M5: ordered pairs (mid, sim_mid, sim) with cosine ``sim > threshold``,
    self pairs removed (P17 strict threshold, R6 zero vectors dropped).

    ``of`` (one column of movie ids): only pairs with one of these movies on
    either side, the others are not built.  ``whole=True``: a movie's pairs
    as one row (mid, recs), best first, of the movies in ``of`` or all."""
    n = n_items if n_items is not None else factors.count()
    if whole:
        return whole_lists(usable(factors, id_col, feat_col), of, float(threshold), block_rows, n)
    if of is not None:
        return pairs_of(usable(factors, id_col, feat_col), of, float(threshold), block_rows, n)
    if n > block_rows:
        # several blocks: gather alike vectors, skip block pairs too far apart
        return similar_pairs(usable(factors, id_col, feat_col), float(threshold), block_rows, n)
    blocks = to_blocks(factors, id_col, feat_col, 1)
    pairs = block_pairs(blocks, blocks, 1, 1, upper=True)
    return pairs.mapInPandas(_cosine_pairs(float(threshold)), SIM_SCHEMA)


def similar_lists(sims: DataFrame) -> DataFrame:
    """(mid, recs) with every similar movie, best first (sorted on
    write; the reference leaves the list unsorted and uncapped).  ``sims``:
    pairs, or the whole lists of ``item_similarity``, which stay where they
    are."""
    if "recs" in sims.columns:
        return sims.select("mid", F.col("recs").cast(RECS).alias("recs"))
    return (sims.groupBy("mid")
            .agg(sort_recs(F.collect_list(F.struct(F.col("sim_mid").alias("mid"),
                                                    F.col("sim").alias("score"))))
                 .cast(RECS).alias("recs")))


# ------------------------------------------------------------- blocked top-k

TOPK_SCHEMA = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])


def _dot_topk(k: int, positive_only: bool):
    def run(batches):
        for pdf in batches:
            outs = []
            for r in pdf.itertuples(index=False):
                iu, u = _matrix(r.ids_a, r.mat_a, r.dim_a)
                ii, v = _matrix(r.ids_b, r.mat_b, r.dim_b)
                if len(iu) == 0 or len(ii) == 0:
                    continue
                s = u @ v.T
                keep = s > 0 if positive_only else np.ones(s.shape, dtype=bool)
                if s.shape[1] > k:
                    # entries at least as good as each row's k-th best (ties
                    # kept), then an exact (score desc, id asc) order below
                    nth = -np.partition(-s, k - 1, axis=1)[:, k - 1]
                    keep &= s >= nth[:, None]
                rows, cols = np.nonzero(keep)
                if len(rows) == 0:
                    continue
                vals = s[rows, cols]
                order = np.lexsort((ii[cols], -vals, rows))
                rows, cols, vals = rows[order], cols[order], vals[order]
                first = np.r_[0, np.flatnonzero(np.diff(rows)) + 1]
                pos = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))
                sel = pos < k
                outs.append(pd.DataFrame({"uid": iu[rows[sel]], "mid": ii[cols[sel]], "score": vals[sel]}))
            if outs:
                yield pd.concat(outs, ignore_index=True).astype(
                    {"uid": "int32", "mid": "int32", "score": "float64"})
    return run


def blocked_top_k(user_factors: DataFrame, item_factors: DataFrame, k: int,
                  positive_only: bool = True, block_rows: int = 4096,
                  n_users: int | None = None, n_items: int | None = None) -> DataFrame:
    """Top ``k`` items per user by dot product -> (uid, rank, mid, score).

    Up to one block of items: every user block meets it.  More: items lie in
    blocks by falling norm, and a user meets only blocks whose norm can still
    reach its k-th best score (``factor_blocks.top_products``).
    """
    ni = n_items if n_items is not None else item_factors.count()
    if ni > block_rows:
        return top_products(usable(user_factors, "id", "features"), usable(item_factors, "id", "features"), k, positive_only, block_rows)
    nu = num_blocks(n_users if n_users is not None else user_factors.count(), block_rows)
    ub = to_blocks(user_factors, "id", "features", nu)
    ib = to_blocks(item_factors, "id", "features", 1)
    cand = block_pairs(ub, ib, nu, 1, upper=False).mapInPandas(_dot_topk(k, positive_only), TOPK_SCHEMA)
    w = Window.partitionBy("uid").orderBy(F.col("score").desc(), F.col("mid").asc())
    return (cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("uid", F.col("rank").cast("int").alias("rank"), "mid", "score"))
