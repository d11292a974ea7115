"""Exact top-k inner-product search by MaxScore (operator 4).

A vector is a document, each dimension a term with an integer weight.  The
candidates are hashed into shards of about ``shard_rows`` rows.  A shard's
postings hold, per term and sign, the rows whose weight has that sign, by
falling impact; the first entry bounds the list.  A query reads the list of
each term whose sign is that of its own weight, so every posting adds to a
score, and weights of the other sign only lower it.

Per query and shard: the heads of its strongest lists, scored in full, give
a threshold (the k-th best of them, or of an earlier shard in the task).  In
order of rising bound, the terms whose bounds together stay below the
threshold are non-essential: a row in none of the other lists cannot reach
it.  The essential postings are traversed and summed; rows whose sum plus
the non-essential bounds stays below the threshold leave, and for the rest
the other terms and signs are probed in steps while they stay competitive.
If no threshold above 0 is known, every row is a candidate.  The shards' k
best are then merged.

Queries and shards meet in cells: a task holds a group of packed queries and
streams a group of shards, so a query is moved once per group of shards, not
once per shard, and nothing is broadcast.  All queries are one group until
they would pass ``HELD_BYTES``, or where shards are fewer than cores.

Defined results: vectors that are null, empty or hold null or non-finite
components take no part; scores tie to the smaller id; only vectors of one
length are compared; a row with a null id can be no query but a candidate
(sorted last on ties); where rows share an id, one of them (the smallest
vector hash) is the query and none is its candidate.  A result's score beyond 64
bits raises.  No rows, no output.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.factor_blocks import HELD_BYTES, _by_cell, _dealt

STEP, HEADS = 16, 8
LONG = 2**63 - 1


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(id, v array<double>, d) of the vectors that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", bad))
    whole = F.transform("v", lambda x: _floor(x * scale))
    return rows.select("id", whole.alias("v"), F.size("v").alias("d"))


def _floor(x):
    """Largest whole number up to x, as double (huge values stay)."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


class Postings:
    """Rows of a shard per term and sign, by falling size of their weight."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.lists = {}
        for term in range(rows.shape[1]):
            w = rows[:, term]
            for sign, own in ((1, w > 0), (-1, w < 0)):
                at = np.flatnonzero(own)
                size = np.abs(w[at])
                fall = np.argsort(-size, kind="stable")
                self.lists[term, sign] = (at[fall], size[fall])

    def of(self, weight: np.ndarray) -> list:
        """(bound, term, rows, sizes of their weights) of the lists that a query
        reads, by rising bound."""
        out = []
        for term, w in enumerate(weight):
            at, size = self.lists[term, 1 if w > 0 else -1]
            if w != 0 and len(at):
                out.append((abs(w) * size[0], term, at, size))
        return sorted(out, key=lambda x: x[:2])


def best_of_query(post: Postings, weight: np.ndarray, apart: np.ndarray, k: int, floor=None):
    """(rows, scores) that hold the query's k best of the shard, but rows
    below ``floor``.  ``apart``: rows that are no candidates."""
    rows, lists = post.rows, post.of(weight)
    heads = np.unique(np.concatenate([at[:k + 1] for _, _, at, _ in lists[-HEADS:]] + [np.zeros(0, np.int64)]))
    heads = heads[~apart[heads]]
    known = sorted(rows[heads] @ weight, reverse=True)
    limit = known[k - 1] if len(known) >= k else None
    if floor is not None and (limit is None or floor > limit):
        limit = floor
    bound = np.cumsum(np.array([x[0] for x in lists], rows.dtype))
    if limit is None or limit <= 0:
        live = np.flatnonzero(~apart)
        return live, rows[live] @ weight
    split = int(np.searchsorted(bound, limit, side="left"))      # lists before it are non-essential
    rest = bound[split - 1] if split else 0
    total = np.zeros(len(rows), rows.dtype)
    for _, term, at, size in lists[split:]:
        total[at] += size * abs(weight[term])
    total[apart] = 0
    live = np.flatnonzero((total > 0) & (total + rest >= limit))
    # most that a candidate can reach: non-essential terms first give up
    # their bound for what they truly add, then weights of the other sign
    reach = total[live] + rest
    spare = {term: top for top, term, _, _ in lists[:split]}
    probe = [term for _, term, _, _ in reversed(lists[:split])]
    probe += [term for term in np.argsort(-np.abs(weight).astype(float), kind="stable") if term not in spare and weight[term] != 0]
    for at in range(0, len(probe), STEP):
        use = np.array(probe[at:at + STEP])
        add = rows[np.ix_(live, use)] * weight[use]
        lower = np.array([term not in spare for term in use])
        add[:, lower] = np.minimum(add[:, lower], 0)             # what is above 0 is in the sum already
        reach = reach + add.sum(axis=1) - sum(spare.get(term, 0) for term in use)
        stay = reach >= limit
        live, reach = live[stay], reach[stay]
    return live, reach


def best_of_shard(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, floors: dict | None = None,
                  post: Postings | None = None):
    """The k best of the shard for every query: (query, row, score) arrays.
    ``own``/``ids``: ids of queries and rows; equal ids are never paired.
    ``floors``: the k-th best score known of each query, kept up to date.
    ``post``: the postings of ``rows``, if they are there."""
    out_q, out_r, out_s = [], [], []
    floors = {} if floors is None else floors
    safe = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * rows.shape[1] < 2.0**52
    if not safe:
        rows, queries = (np.array([int(x) for x in a.ravel()], object).reshape(a.shape) for a in (rows, queries))
    post = post if post is not None and safe else Postings(rows)
    for q, weight in enumerate(queries):
        live, score = best_of_query(post, weight, ids == own[q], k, floors.get(q))
        if not len(live):
            continue
        best = np.lexsort((ids[live], -score))[:k] if safe else \
            np.array(sorted(range(len(live)), key=lambda i: (-score[i], ids[live[i]]))[:k])
        if len(best) == k and (q not in floors or score[best[-1]] > floors[q]):
            floors[q] = score[best[-1]]
        out_q.append(np.full(len(best), q))
        out_r.append(live[best])
        out_s.append(np.array([int(s) for s in score[best]], object))
    join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
    return join(out_q), join(out_r), join(out_s)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vec_col: str = "embedding", shard_rows: int = 8192, query_rows: int = 1024) -> DataFrame:
    """(query_id, rank, <id_col>, score) of each query's k best vectors."""
    rows, asked = quantised(vectors, id_col, vec_col, scale), quantised(queries, id_col, vec_col, scale)
    first = Window.partitionBy("id").orderBy(F.xxhash64("v"))
    asked = asked.filter("id is not null").withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n")
    shards = max(1, -(-rows.count() // shard_rows))
    size = asked.agg(F.count("*").alias("n"), F.sum(F.col("d").cast("long")).alias("d")).first()
    groups = max(1, -(-size.n // query_rows))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["id"].to_numpy(dtype=np.float64, na_value=np.nan)
        known = ~np.isnan(ids)
        whole = np.full(len(pdf), LONG, np.int64)
        whole[known] = pdf["id"][known].astype("int64")
        mat = np.stack(pdf["v"].to_numpy()).astype(np.float64)
        return pd.DataFrame({"b": [int(pdf["b"].iloc[0])], "d": [int(pdf["d"].iloc[0])],
                             "ids": [whole.tobytes()], "known": [known.tobytes()], "mat": [mat.tobytes()]})

    block = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n))
    kind = "b long, d int, ids binary, known binary, mat binary"
    cores = rows.sparkSession.sparkContext.defaultParallelism
    left = max(1, min(groups, max(-(-8 * (size.d or 0) // HELD_BYTES), -(-cores // shards))))      # groups of queries, and of shards
    right = max(1, min(shards, -(-2 * cores // left)))
    other = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("o")
    cell = lambda g, h: (g * right + h).cast("int").alias("cell")
    sets = asked.withColumn("b", block(groups)).repartition(max(1, min(groups, 2 * cores)), "b", "d").groupBy("b", "d").applyInPandas(pack, kind)
    sets = sets.select("b", "d", "ids", "known", "mat", other(right)).select("b", "d", "ids", "known", "mat", cell(F.pmod("b", F.lit(left)), F.col("o")))
    packed = rows.withColumn("b", block(shards)).repartition(max(2 * cores, shards // 8), "b", "d").groupBy("b", "d").applyInPandas(pack, kind)
    packed = packed.select("b", "d", "ids", "known", "mat", other(left)).select("b", "d", "ids", "known", "mat", cell(F.col("o"), F.pmod("b", F.lit(right))))

    def search(batches):
        matrix = lambda r: np.frombuffer(r.mat, np.float64).reshape(-1, r.d)
        for held, met in _by_cell(batches):
            queries = [(r.d, np.frombuffer(r.ids, np.int64), matrix(r), {}) for r in held]
            held.clear()
            for r in met:
                ids, known, mat, post = np.frombuffer(r.ids, np.int64), np.frombuffer(r.known, bool), matrix(r), None
                for d, own, ask, floors in queries:
                    if d != r.d:
                        continue
                    post = post or Postings(mat)
                    q, at, s = best_of_shard(ask, own, mat, ids, k, floors, post)
                    vec = pd.array(ids[at], "Int64")
                    vec[~known[at]] = pd.NA
                    yield pd.DataFrame({"query_id": own[q], "vec": vec, "score": s})

    found = _dealt(sets, packed, left * right, "b").mapInPandas(search, "query_id long, vec long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", F.col("vec").alias(id_col), "score")
