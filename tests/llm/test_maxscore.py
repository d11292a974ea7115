"""MaxScore against brute force: sparse and dense weights, both signs, ties,
shared and null ids, weights beyond exact doubles."""

import numpy as np
import pytest


def brute(queries, own, rows, ids, k):
    out = {}
    for q, w in enumerate(queries):
        scored = [(-sum(int(a) * int(b) for a, b in zip(w, r)), int(i), n) for n, (r, i) in enumerate(zip(rows, ids)) if i != own[q]]
        out[q] = [(i, -s) for s, i, _ in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("seed", range(12))
def test_best_of_shard_equals_brute_force(seed):
    from marquee.llm.topk import best_of_shard
    r = np.random.default_rng(seed)
    n, d, k = int(r.integers(1, 300)), int(r.integers(1, 50)), int(r.integers(1, 7))
    low = -9 if seed % 3 else 0
    rows = r.integers(low, 10, (n, d)) * (r.random((n, d)) < r.choice([0.05, 0.3, 1.0]))
    queries = r.integers(low, 10, (9, d)) * (r.random((9, d)) < r.choice([0.1, 1.0]))
    rows, queries = rows.astype(float), queries.astype(float)
    if seed % 4 == 3:
        rows, queries = rows * 2.0**28, queries * 2.0**26
    ids, own = np.arange(n) // (1 + seed % 2), r.integers(0, n, 9)
    floors, found = {}, {}
    cut = n // 2
    for part in (slice(0, cut), slice(cut, n)):              # two shards, thresholds carried
        if part.stop > part.start:
            q, at, s = best_of_shard(queries, own, rows[part], ids[part], k, floors)
            for a, b, c in zip(q, at, s):
                found.setdefault(int(a), []).append((int(ids[part][b]), int(c)))
    want = brute(queries, own, rows, ids, k)
    for q in range(9):
        got = sorted(found.get(q, []), key=lambda x: (-x[1], x[0]))[:k]
        assert got == want[q]


def test_terms_are_split_and_rows_left_out():
    """One strong term: rows without it are never scored in full."""
    from marquee.llm.topk import Postings, best_of_query
    rows = np.zeros((1000, 20))
    rows[:, 1:] = np.random.default_rng(1).integers(-2, 3, (1000, 19))
    rows[:30, 0] = np.arange(1000, 1030)
    live, score = best_of_query(Postings(rows), np.ones(20), np.zeros(1000, bool), 5)
    assert set(live) <= set(range(30)) and (rows[live] @ np.ones(20) == score).all()


def test_top_k_of_odd_rows(spark):
    from marquee.llm.topk import top_k
    rows = [(0, [1.0, 1.0]), (0, [1.0, 2.0]), (None, [5.0, 5.0]), (1, [2.0, 2.0]), (2, [2.0, 2.0]), (3, [2.0, 2.0]), (4, [-1.0, -1.0]), (5, [0.0, 0.0]),
            (6, [float("inf"), 1.0]), (7, [3.0]), (8, [])]
    df = spark.createDataFrame([(i, v, "own", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, rank int").repartition(3)
    got = {}
    for r in top_k(df, df.filter("vec_id in (0, 4, 7)"), k=4, shard_rows=3).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ids = lambda q: [i for _, i, _ in sorted(got[q])]
    assert ids(0) == [None, 1, 2, 3] and 7 not in got
    assert sorted(got[4]) == [(1, 5, 0), (2, 0, -2 * 65536), (3, 0, -3 * 65536), (4, 1, -4 * 65536)]


def test_scores_beyond_64_bits_raise(spark):
    from marquee.llm.topk import top_k
    df = spark.createDataFrame([(i, [1e300, float(i)]) for i in range(4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large|too big"):
        top_k(df, df.filter("vec_id = 0")).collect()


def test_queries_are_not_broadcast(spark):
    """a query goes once to each group of shards, by a shuffle; copies for
    every shard were joined, and broadcast through the driver."""
    from marquee.llm.topk import top_k
    r = np.random.default_rng(8)
    vecs = {i: v for i, v in enumerate(r.integers(-9, 10, (400, 6)).tolist())}
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vecs.items()], "vec_id long, embedding array<double>")
    rows = rows.unionByName(spark.createDataFrame([(1000 + i, [1.0, float(i)]) for i in range(9)], rows.schema))
    vecs |= {1000 + i: [1, i] for i in range(9)}
    best = top_k(rows, rows.filter("vec_id % 5 = 0"), 3, 1, shard_rows=16, query_rows=8)
    got = {(x.query_id, x["rank"]): (x.vec_id, x.score) for x in best.collect()}
    assert "BroadcastExchange" not in best._jdf.queryExecution().executedPlan().toString()
    for q in (i for i in vecs if i % 5 == 0):
        want = sorted((-int(np.dot(vecs[q], v)), i) for i, v in vecs.items() if i != q and len(v) == len(vecs[q]))[:3]
        assert [got[q, n] for n in (1, 2, 3)] == [(i, -s) for s, i in want]
