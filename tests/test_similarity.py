"""Blocked similarity and top-k equal brute force (numpy) on fixtures
spanning several blocks."""

import numpy as np
from pyspark.sql import functions as F

from marquee.operators import similarity as sim


def factors(spark, n=60, d=5, seed=3, zero=True):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d))
    if zero:
        m[7] = 0.0
    rows = [(i * 3 + 1, [float(x) for x in m[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "mid int, features array<double>"), {r[0]: np.array(r[1]) for r in rows}


def brute(vecs, t):
    out = {}
    for a, va in vecs.items():
        for b, vb in vecs.items():
            if a == b:
                continue
            na, nb = np.linalg.norm(va), np.linalg.norm(vb)
            if na == 0 or nb == 0:
                continue
            s = va @ vb / (na * nb)
            if s > t:
                out[(a, b)] = s
    return out


def test_blocked_similarity_equals_brute_force(spark):
    df, vecs = factors(spark)
    got = {(r.mid, r.sim_mid): r.sim for r in sim.item_similarity(df, 0.2, block_rows=16).collect()}
    want = brute(vecs, 0.2)
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert all((b, a) in got for (a, b) in got)          # symmetric
    assert all(-1 - 1e-9 <= v <= 1 + 1e-9 for v in got.values())
    assert not any(7 * 3 + 1 in k for k in got)           # zero vector dropped


def test_similar_lists_sorted(spark):
    df, _ = factors(spark)
    lists = sim.similar_lists(sim.item_similarity(df, 0.2, block_rows=16)).collect()
    for r in lists:
        scores = [x.score for x in r.recs]
        assert scores == sorted(scores, reverse=True)


def test_blocked_top_k_equals_brute_force(spark):
    users, uv = factors(spark, n=30, seed=5, zero=False)
    items, iv = factors(spark, n=50, seed=9, zero=False)
    u = users.withColumnRenamed("mid", "id")
    i = items.withColumnRenamed("mid", "id")
    got = {}
    for r in sim.blocked_top_k(u, i, 4, positive_only=True, block_rows=8).collect():
        got.setdefault(r.uid, []).append((r.rank, r.mid))
    for uid, vec in uv.items():
        scores = sorted(((-(vec @ v), m) for m, v in iv.items() if vec @ v > 0))[:4]
        assert [m for _, m in scores] == [m for _, m in sorted(got.get(uid, []))]


def clustered(spark, n=400, d=12, seed=2, spread=0.08):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(8, d))
    m = middle[rng.integers(0, 8, n)] + spread * rng.normal(size=(n, d))
    rows = [(i + 1, [float(x) for x in v]) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, "mid int, features array<double>"), {r[0]: np.array(r[1]) for r in rows}


def test_far_block_pairs_are_skipped(spark):
    from marquee.operators import factor_blocks as fb
    df, vecs = clustered(spark)
    blocks = fb.unit_blocks(fb.usable(df, "mid", "features"), 20, 400)
    nb = blocks.count()
    pairs = fb.near_pairs(blocks, 0.9)
    kept, every = pairs.count(), nb * (nb + 1) // 2
    assert nb >= 20 and kept < 0.5 * every, (kept, every)
    got = {(r.mid, r.sim_mid): r.sim for r in sim.item_similarity(df, 0.9, block_rows=20).collect()}
    want = brute(vecs, 0.9)
    assert set(got) == set(want) and want


def test_copies_of_a_vector_over_blocks(spark):
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(90)] + [(100 + i, [0.1 * i, 1.0, -1.0]) for i in range(30)] + [(500, None), (501, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "mid int, features array<double>")
    got = {(r.mid, r.sim_mid) for r in sim.item_similarity(df, 0.8, block_rows=16).collect()}
    assert got == set(brute({i: np.array(v) for i, v in rows if v is not None}, 0.8))


def test_norm_ordered_blocks_equal_brute_force_and_stop_early(spark):
    from marquee.operators import factor_blocks as fb
    rng = np.random.default_rng(8)
    items = {i: rng.normal(size=6) * (5.0 if i % 40 == 0 else 0.2) for i in range(1, 600)}
    users = {i: rng.normal(size=6) for i in range(1, 90)}
    make = lambda d: fb.usable(spark.createDataFrame([(i, [float(x) for x in v]) for i, v in d.items()], "id int, features array<double>"), "id", "features")
    for positive in (True, False):
        got = {}
        for r in fb.top_products(make(users), make(items), 5, positive, block_rows=32).collect():
            got.setdefault(r.uid, []).append((r["rank"], r.mid))
        for u, vec in users.items():
            want = sorted((-(vec @ v), m) for m, v in items.items() if vec @ v > 0 or not positive)[:5]
            assert [m for _, m in want] == [m for _, m in sorted(got.get(u, []))]
    small = spark.createDataFrame([(1, 0, 3.0, 4.0), (2, 0, 1.0, 2.0)], "block long, n int, least double, most double").withColumns(
        {"ids": F.lit(b""), "mat": F.lit(b"")})
    asked = spark.createDataFrame([(7, 0, 2.5, 9.0)], "block long, n int, least double, most double").withColumns({"ids": F.lit(b""), "mat": F.lit(b"")})
    assert [(r.u, r.i) for r in fb._meet(asked, small, [(1, 4.0), (2, 2.0)], True).collect()] == [(7, 1)]      # the second block cannot reach it


def test_no_factors(spark):
    from marquee.operators import factor_blocks as fb
    none = spark.createDataFrame([], "id int, features array<double>")
    some = spark.createDataFrame([(1, [1.0])], "id int, features array<double>")
    assert fb.top_products(fb.usable(some, "id", "features"), fb.usable(none, "id", "features"), 3).count() == 0
    assert fb.similar_pairs(fb.usable(none, "id", "features"), 0.5, 4, 0).count() == 0
