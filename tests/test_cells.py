"""Block pairs meet in cells: how often a block is moved does not grow with
the number of blocks."""

import numpy as np
from pyspark.sql import functions as F

from marquee.operators import factor_blocks as fb
from marquee.operators import similarity as sim


def vectors(spark, n, d=6, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(i + 1, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(n, d)))]
    return fb.usable(spark.createDataFrame(rows, "id int, features array<double>"), "id", "features"), {r[0]: np.array(r[1]) for r in rows}


def test_a_block_is_moved_as_often_however_many_there_are(spark):
    moved = []
    for n in (300, 1200):
        blocks = fb.unit_blocks(vectors(spark, n)[0], 4, n)
        dealt = fb._in_pairs(blocks, ["ids", "mat"], "block")
        moved.append(dealt.count() / blocks.count())
        assert dealt.select("cell").distinct().count() > 4          # and the work is spread
        assert dealt.groupBy("cell", "met", "block").count().filter("count > 1").count() == 0
    assert moved[0] == moved[1]


def test_pairs_over_many_cells_come_once(spark):
    factors, vecs = vectors(spark, 300)
    rows = [(r.mid, r.sim_mid) for r in fb.similar_pairs(factors, 0.5, 4, 300).collect()]
    unit = {k: v / np.linalg.norm(v) for k, v in vecs.items()}
    want = {(a, b) for a in unit for b in unit if a != b and unit[a] @ unit[b] > 0.5}
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_a_cell_gives_k_rows_a_user(spark):
    """Not k rows for each pair of blocks; ties go to smaller ids."""
    users, uv = vectors(spark, 60, seed=5)
    items, iv = vectors(spark, 800, seed=6)
    items = items.unionByName(items.select((F.col("id") + 1000).alias("id"), "v"))
    norm = lambda df: df.withColumn("norm", fb._norm()).withColumn("least", F.lit(0.0))
    u, i = fb._packed(norm(users), "least", 4, "u"), fb._packed(norm(items), "norm", 4, "i")
    per_user = fb._products(u, i, 3, True).groupBy("uid").count().agg(F.max("count")).first()[0]
    assert i.count() > 200 and per_user <= 3 * fb._groups(i)
    got = {(r.uid, r["rank"]): r.mid for r in fb.top_products(users, items, 3, True, 4).collect()}
    for n, v in uv.items():
        want = sorted((-(v @ w), m) for i, w in iv.items() for m in (i, i + 1000) if v @ w > 0)[:3]
        assert [got[(n, r)] for r in (1, 2, 3)] == [m for _, m in want]


def test_lists_leave_their_task_whole(spark):
    """No pair is moved, and a movie with two rows has one list; with
    ``of`` other movies' lists and pairs are not built."""
    factors, vecs = vectors(spark, 300)
    twice = factors.select(F.col("id").alias("mid"), F.col("v").alias("features")).unionByName(
        factors.filter("id = 5").select((F.col("id") + 1).alias("mid"), F.col("v").alias("features")))
    of = spark.createDataFrame([(5,), (6,), (100,), (None,), (0,)], "mid int")
    rows = [(k, v / np.linalg.norm(v)) for k, v in vecs.items()]
    rows.append((6, rows[4][1]))
    want = [(a, b, round(float(u @ v), 6)) for i, (a, u) in enumerate(rows) for j, (b, v) in enumerate(rows) if i != j and u @ v > 0.5]
    for only in (None, of):
        asked = set(vecs) if only is None else {5, 6, 100}
        lists = sim.similar_lists(sim.item_similarity(twice, 0.5, block_rows=16, of=only, whole=True))
        plan = lists._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "Exchange" not in plan.split("MapInArrow")[0]
        got = [(r.mid, [(x.mid, round(x.score, 6)) for x in r.recs]) for r in lists.collect()]
        assert len(got) == len({m for m, _ in got})
        assert dict(got) == {m: sorted(((b, s) for a, b, s in want if a == m), key=lambda x: (-x[1], x[0])) for m in {a for a, _, _ in want} & asked}
        if only is not None:
            pairs = sim.item_similarity(twice, 0.5, block_rows=16, of=only)
            assert sorted((r.mid, r.sim_mid, round(r.sim, 6)) for r in pairs.collect()) == sorted(w for w in want if asked & {w[0], w[1]})


def test_few_pairs_are_multiplied_in_full():
    """rounded products of tiles choose the pairs; all that may be
    among a row's k best are there, and few others."""
    rng = np.random.default_rng(9)
    rows, items = rng.normal(size=(700, 40)), rng.normal(size=(3000, 40)) * 1e6
    items[5] = items[2999] = items[17]                       # ties
    norm, k = np.linalg.norm(rows, axis=1), 10
    most = float(np.linalg.norm(items, axis=1).max())
    need, mine = np.zeros(700), np.arange(0, 700, 2)
    pairs = [np.stack(p) for p in fb._reaching((rows / norm[:, None]).astype(np.float32), mine, need, items, most, k)]
    got = set(map(tuple, np.concatenate(pairs, axis=1).T.tolist()))
    score = rows @ items.T
    for row in mine.tolist():
        kth = np.sort(score[row])[-k]
        assert {(row, c) for c in np.flatnonzero(score[row] >= kth).tolist()} <= got
        assert need[row] * norm[row] <= kth
    assert len(got) < 8 * k * len(mine) and not need[1::2].any()


def test_huge_and_tiny_vectors(spark):
    """Norms beyond single numbers are multiplied in full."""
    items = spark.createDataFrame([(i, [s * x, s]) for i, (s, x) in enumerate([(1e120, 2.0), (1e-120, 3.0), (1.0, 1.0), (1e30, -5.0), (1e-30, 7.0)])], "id int, v array<double>")
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1e-120, 1e-120]), (3, [1e60, 1e60])], items.schema)
    got = {(r.uid, r["rank"]): (r.mid, r.score) for r in fb.top_products(users, items, 2, True, 2).collect()}
    assert {k: v[0] for k, v in got.items()} == {(1, 1): 0, (1, 2): 2, (2, 1): 3, (3, 1): 0, (3, 2): 2} and got[1, 1][1] == 2e120
